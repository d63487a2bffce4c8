"""Induced sorting against plain sorting, and suffix-array dedup against counting all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from innkeeper.llm import suffix_dedup
from innkeeper.llm.induced_sort import CAP, Disk, suffix_array


def symbol_strings():
    rng = random.Random(5)
    for _ in range(250):
        n, k = rng.randrange(rng.choice([2, 40, 300])), rng.choice([1, 2, 3, 30])
        yield rng, k, [rng.randrange(1, k + 1) for _ in range(n)]
        yield rng, k, [c for _ in range(n // 6) for c in [rng.randrange(1, k + 1)] * rng.randrange(1, 12)]
        unit = [rng.randrange(1, k + 1) for _ in range(rng.randrange(1, 8))]
        yield rng, k, (unit * 60)[:n]


def test_induced_sort_is_sorting():
    for rng, k, x in symbol_strings():
        x = [*x, 0]
        order = sorted(range(len(x)), key=lambda i: x[i:])
        shared = [0] * len(x)
        for r in range(1, len(x)):
            a, b = x[order[r - 1]:], x[order[r]:]
            shared[r] = next((m for m, (p, q) in enumerate(zip(a, b)) if p != q or m == CAP), min(len(a), len(b)))
        # No memory for queues sends every tuple through the disk; a piece of 1 scans one suffix at a time.
        got = suffix_array(np.array(x, np.int32), k + 1, Disk(rng.choice([0, 100, 1 << 20])), rng.choice([1, 7, 50, 1 << 16]))
        assert got[0].tolist() == order
        assert got[1].tolist() == shared


def test_one_long_run_is_sorted_at_once():
    x = np.append(np.ones(1_000_000, np.uint8), np.uint8(0))
    order, lcp = suffix_array(x, 2, Disk(1 << 26))
    assert np.array_equal(order, np.arange(1_000_000, -1, -1))
    assert np.array_equal(lcp, np.minimum(np.arange(-1, 1_000_000), CAP).clip(0))


def brute(texts, size):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + size] for b in raw for i in range(len(b) - size + 1))
    out = []
    for b in raw:
        keep = [True] * len(b)
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                keep[i:i + size] = [False] * size
        kept = bytes(c for c, k in zip(b, keep) if k)
        spans = sum(not k and (i == 0 or keep[i - 1]) for i, k in enumerate(keep))
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], len(r["removed_starts"]), r["kept_sha256"])
                  for r in df.collect())


def wanted(ids, texts, size=200):
    return sorted((i is None, i or 0, *w) for i, w in zip(ids, brute(texts, size)))


def test_dedup(docs, corpus):
    want = wanted([c[0] for c in corpus], [c[1] for c in corpus])
    assert rows(suffix_dedup.remove_repeats(docs)) == want
    assert sum(w[3] for w in want) > 0


@pytest.mark.parametrize("size", [40, 64, 255])
def test_other_sizes(docs, corpus, size):
    assert rows(suffix_dedup.remove_repeats(docs, size)) == wanted([c[0] for c in corpus], [c[1] for c in corpus], size)


def test_keys_of_many_strings_are_cut_into_windows(docs, corpus, monkeypatch):
    from pyspark import cloudpickle

    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    cloudpickle.register_pickle_by_value(suffix_dedup)  # so that workers see the lower bound
    try:
        got = rows(suffix_dedup.remove_repeats(docs))
    finally:
        cloudpickle.unregister_pickle_by_value(suffix_dedup)
    assert got == wanted([c[0] for c in corpus], [c[1] for c in corpus])


def test_spans_and_kept_bytes(docs, corpus):
    for r in suffix_dedup.remove_repeats(docs, with_text=True).collect():
        raw = (corpus[r["doc_id"]][1] or "").encode()
        gone = {i for a, z in zip(r["removed_starts"], r["removed_ends"]) for i in range(a, z)}
        assert len(gone) == r["n_removed"]
        assert all(z < a for z, a in zip(r["removed_ends"], r["removed_starts"][1:]))
        assert bytes(r["kept"]) == bytes(c for i, c in enumerate(raw) if i not in gone)


def test_edges(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abc é€\U0001F600\x00") for _ in range(300))
    longest = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    texts = [text, text, text[:199], text[:200], "x" * 199, "x" * 200, "y" * 201, "ab" * 5000, "-" * 30_000, None, "", "short",
             longest, longest[:300_000] + "!" + longest[300_000:], "z" * 150 + text[50:250], text[100:] + "q" * 200 + text[:100], text]
    ids = [1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, None, None, 1]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    assert rows(suffix_dedup.remove_repeats(df)) == wanted(ids, texts)


def test_empty_and_clashing(spark, empty, clashing, corpus):
    assert suffix_dedup.remove_repeats(empty).collect() == []
    extra = clashing
    for name in ("kind", "part", "string", "text_id", "of", "n", "bits", "first", "h1", "h2", "times", "counted", "says", "bucket"):
        extra = extra.selectExpr("*", f"'x' AS {name}")
    assert rows(suffix_dedup.remove_repeats(extra)) == wanted([c[0] for c in corpus[:20]], [c[1] for c in corpus[:20]])
    named = spark.createDataFrame([("a", "x" * 200), ("b", "x" * 200)], "name string, body string")
    assert [r["n_removed"] for r in suffix_dedup.remove_repeats(named, key="name", text="body").collect()] == [200, 200]
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(named, size=32)
