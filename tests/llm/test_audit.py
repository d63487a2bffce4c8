"""Source audit and hard negatives against plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import re

from innkeeper.llm import hard_negatives, source_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audited(docs, least=10, top=10):
    """Rows of (text, lang, source)."""
    counts, found, groups = defaultdict(Counter), defaultdict(set), set()
    for k, (t, lang, source) in enumerate(docs):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for w in TERM.findall((t or "").translate(LOWER)):
            counts[lang, source][w] += 1
            found[lang, w].add(k)
    out = []
    for lang in {g for g, _ in groups}:
        kept = [w for (g, w), d in found.items() if g == lang and len(d) >= least]
        sources = sorted(s for g, s in groups if g == lang)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def share(c):
            total = sum(c[w] for w in kept)
            return {w: 1 + 10 ** 9 * (c[w] + 2) // (total + 2 * len(kept)) for w in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [(-sum((p[s][w] - p[o][w]) ** 2 // (p[s][w] + p[o][w]) for w in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-((p[s][w] - q[w]) ** 2 // (p[s][w] + q[w])), w.encode(), w) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            out += [(lang, s, "pair", w, -v, k) for k, (v, _, w) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", w, -v, k) for k, (v, _, w) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def audit_rows(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


@pytest.mark.parametrize("small", [4, 1 << 16])
def test_multikey_sort_is_sorting(monkeypatch, small):
    monkeypatch.setattr(source_audit, "SMALL", small)
    rng = random.Random(2)
    for many, kinds, longest in [(0, 1, 1), (1, 1, 1), (300, 40, 30), (9000, 300, 9), (9000, 3000, 25), (6000, 1, 70)]:
        vocabulary = [bytes(rng.choice(b"ab\xc3\xa9z") for _ in range(rng.randrange(1, longest + 1))) for _ in range(kinds)]
        words = [rng.choice(vocabulary) for _ in range(many)]
        text = np.frombuffer(b"".join(words) + b"\0" * 8, np.uint8)
        length = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(length) - length
        order, heads = source_audit.multikey_sort(text, start, length)
        assert [words[k] for k in order] == sorted(words) and sorted(order.tolist()) == list(range(many))
        assert heads.tolist() == [k for k in range(many) if k == 0 or words[order[k]] != words[order[k - 1]]]


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(4)
    out = []
    for k in range(150):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "é", None, "Z"])
        words = [f"{rng.choice(['w', 'W', 'Ü', 'mot'])}{'xyz'[rng.randrange(3)] * rng.randrange(12)}" for _ in range(rng.randrange(60))]
        out.append((" ".join(words) if k % 9 else rng.choice([None, "", "12 -- 34"]), lang, source))
    return out + [("lonely", "xx", "one"), (None, "xx", "two"), ("long" * 30_000 + " tail", "en", "a")] + out[:3]


def test_audit(spark, sources, monkeypatch):
    df = spark.createDataFrame(sources, "text string, lang string, source string").repartition(4)
    want = audited(sources)
    assert audit_rows(source_audit.audit(df)) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[2] == "pair" and r[4] for r in want)
    assert audit_rows(source_audit.audit(df, least=2, top=3)) == audited(sources, 2, 3)


def test_audit_of_nothing(spark, sources, empty):
    assert source_audit.audit(empty).collect() == []
    df = spark.createDataFrame(sources[:3], "text string, lang string, source string")
    extra = df.selectExpr("*", *[f"'x' AS {c}" for c in ("term", "n", "docs", "p", "q", "v", "total", "rank", "value", "item", "size", "p0")])
    assert audit_rows(source_audit.audit(extra)) == audited(sources[:3])


def mined(rows, anchors):
    """Rows (id, label, integers)."""
    out = []
    for a, label, v in rows:
        if a not in anchors:
            continue
        scored = sorted((-int(np.dot(v, w)), i, other) for i, other, w in rows if i != a)
        for s, i, other in [x for x in scored if x[2] == label][:5]:
            window = [(t, j) for t, j, o in scored if o != label and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(a, i, k, j, -s, -t) for k, (t, j) in enumerate(window, 1)]
    return sorted(out)


def mine_rows(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


def vectors(n, dimension, kinds, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(kinds, dimension))
    which = rng.integers(0, kinds, n)
    v = centres[which] + 0.3 * rng.normal(size=(n, dimension))
    v /= np.linalg.norm(v, axis=1)[:, None]
    v[n // 2:n // 2 + n // 10] = v[0]  # many equal vectors
    return [(i, int(rng.integers(0, 4)), [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize("leaf_rows", [2048, 100, 12])
def test_mine(spark, monkeypatch, leaf_rows):
    for name, value in (("LEAF_ROWS", leaf_rows), ("BLOCK", 50), ("ANCHOR_PART", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    raw = vectors(700, 12, 9, 3)
    rows = [(i, label, [int(np.floor(256 * x)) for x in v]) for i, label, v in raw]
    df = hard_negatives.quantized(spark.createDataFrame(raw, "vec_id long, label int, embedding array<double>").repartition(3))
    got = mine_rows(hard_negatives.mine(df, df.where(F.col("id") % 20 == 0)))
    want = mined(rows, set(range(0, 700, 20)))
    assert got == want and len(want) > 300


def test_leaves_are_left_out():
    rng = np.random.default_rng(1)
    rows = np.floor(256 * np.concatenate([rng.normal(size=(500, 6)) * 0.02 + c for c in rng.normal(size=(12, 6))]))
    most = float((rows * rows).sum(1).max())
    x = hard_negatives.lifted(rows, most)
    tree = hard_negatives.Tree(x, 40)
    leaf, bounds = tree.place(x), {}
    for one in np.unique(leaf):
        for at in tree.paths[one]:
            d = np.sqrt(hard_negatives.distances2(x[leaf == one], tree.nodes[at[0]].points))
            low, high = bounds.get(at, (np.inf, 0))
            bounds[at] = np.minimum(low, d.min(0)), np.maximum(high, d.max(0))
    anchors = np.column_stack([rows[::50], np.zeros(len(rows[::50]))])
    far = np.sqrt(hard_negatives.distances2(anchors, x))
    inner, outer = np.quantile(far, 0.30, axis=1), np.quantile(far, 0.33, axis=1)
    a, b = tree.reached(anchors, inner, outer, bounds)
    reached = set(zip(a.tolist(), b.tolist()))
    assert len(reached) < 0.7 * len(anchors) * len(np.unique(leaf))
    inside = (far >= inner[:, None]) & (far <= outer[:, None])
    assert all((k, leaf[r]) in reached for k, r in zip(*np.nonzero(inside)))


def test_mine_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.8, 0.0]), (3, 2, [0.8, 0.0]), (4, 2, [-1.0, 0.0]), (5, 1, [1.0, nan]),
            (6, 2, [inf, 0.0]), (7, 2, None), (8, None, [1.0, 1.0]), (9, 2, [None, 1.0]), (10, 2, [1.0]), (11, 2, []), (None, 2, [1.0, 0.0]),
            (0, 1, [1.0, 0.0]), (12, 3, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    extra = df.selectExpr("*", *[f"'x' AS {c}" for c in ("id", "vector", "leaf", "block", "part", "score", "low", "high", "rank")])
    for frame in (df, extra):
        q = hard_negatives.quantized(frame)
        got = mine_rows(hard_negatives.mine(q, q.where("id IN (0, 12, 5)")))
        assert got == [(0, 1, 1, 2, 230 * 256, 204 * 256), (0, 1, 2, 3, 230 * 256, 204 * 256)]
    none = hard_negatives.quantized(df.limit(0))
    assert hard_negatives.mine(none, none).collect() == []
    q = hard_negatives.quantized(df)
    assert hard_negatives.mine(q, q.where("id = 99")).collect() == []
