"""Quality rules, substring dedup, decontamination, secrets: against brute force and at the edges."""

import brute
from pyspark.sql import functions as F

from innkeeper.llm import quality_rules, secret_entropy, substring_dedup, suffix_decontam


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_quality_measures(docs, corpus):
    got = by_id(quality_rules.ledger(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == {i: brute.quality(t) for i, t, *_ in corpus}


def test_quality_policies_and_ablations(docs):
    rows = quality_rules.apply_policy(quality_rules.ledger(docs), "web-1").collect()
    mask = quality_rules.mask_of("web-1")
    assert all(r["kept"] == (r["failed"] & mask == 0) for r in rows)
    table = {r["rule"]: r for r in quality_rules.ablations(quality_rules.ledger(docs), "web-1").collect()}
    for rule in quality_rules.rules():
        bit = 1 << rule.bit
        assert table[rule.name]["rejected"] == sum(bool(r["failed"] & bit) for r in rows)
        assert table[rule.name]["sole"] == sum(r["failed"] == bit for r in rows) == sum(r["sole_rule"] == rule.name for r in rows)
        assert table[rule.name]["kept_without"] == sum(r["failed"] & mask & ~bit == 0 for r in rows)


def test_substring_dedup(docs, corpus):
    got = by_id(substring_dedup.remove_repeats(docs), "n_words", "n_removed", "kept_sha256")
    want = brute.repeats([t for _, t, *_ in corpus])
    assert got == {c[0]: w for c, w in zip(corpus, want)}
    assert any(w[1] for w in want)


def test_substring_intervals_are_maximal(docs, corpus):
    out = substring_dedup.remove_repeats(docs, size=20, with_text=True).collect()
    for r in out:
        w = brute.words(corpus[r["doc_id"]][1])
        gone = [i for a, z in zip(r["removed_starts"], r["removed_ends"]) for i in range(a, z)]
        assert len(gone) == r["n_removed"] == len(set(gone))
        assert all(z < a for z, a in zip(r["removed_ends"], r["removed_starts"][1:]))
        assert r["kept_text"] == " ".join(x for i, x in enumerate(w) if i not in set(gone))


def test_repeated_rows_are_repeats(spark):
    text = " ".join(f"a{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (1, text), (2, text + " tail"), (None, text)], "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup.remove_repeats(df).orderBy("n_words").collect()] == [40] * 4


def bench_items(corpus):
    long = brute.bench_words(corpus[70][1] or "") or brute.bench_words(corpus[3][1])
    near = brute.bench_words(corpus[45][1])
    return [(1, " ".join(near[20:60])), (2, " ".join(near[30:45])), (10, "Two WORDS!"), (None, " ".join(near[50:64])),
            (4, None), (5, ""), (6, " ".join(long[:13])), (2, " ".join(near[30:45])), (7, "same same"), (8, " ".join(near[5:9]))]


def test_decontamination(spark, docs, corpus):
    items = bench_items(corpus)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination([t for _, t, *_ in corpus], items)
    assert sum(w[1] > 0 for w in want) > 10
    for block in (16 << 20, 60):  # one block, and several that the documents pass through in turn
        out = suffix_decontam.find_matches(docs, bench, block_chars=block).select(
            "doc_id", "_n_words", "_n_hit", F.size("_items").alias("n"),
            F.sha2(F.array_join(F.array_sort("_items"), ","), 256).alias("sha"), suffix_decontam.contaminated().alias("bad"))
        assert by_id(out, "_n_words", "_n_hit", "n", "sha", "bad") == {c[0]: w for c, w in zip(corpus, want)}
    clean = suffix_decontam.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {c[0] for c, w in zip(corpus, want) if not w[4]}


def test_longest_match(spark):
    item = [f"q{i}" for i in range(30)]
    text = " ".join(["p"] * 5 + item[2:22] + ["p"] + item[:13])
    df = spark.createDataFrame([(1, text), (2, " ".join(item[:12]))], "doc_id long, text string")
    out = suffix_decontam.find_matches(df, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert by_id(out, "_longest", "_longest_start", "_n_hit") == {1: (20, 5, 33), 2: (0, -1, 0)}
    assert by_id(out, "_spans") == {1: ([(5, 25), (26, 39)],), 2: ([],)}


def test_locations_over_blocks_of_the_benchmark(spark):
    """Spans and the first longest match are the same whichever block an item lies in."""
    items = [(k, " ".join(f"q{k}x{i}" for i in range(13 + k % 3))) for k in range(12)]
    text = " ".join(["p", items[4][1], "p p", items[5][1], "p", items[7][1], items[8][1], "p"])
    df = spark.createDataFrame([(1, text), (2, "p p p"), (3, items[2][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, many = (by_id(suffix_decontam.find_matches(df, bench, block_chars=b), "_longest", "_longest_start", "_spans", "_n_hit")
                 for b in (1 << 20, 90))
    assert one == many
    assert one[1][:2] == (15, 17) and one[1][2] == [(1, 15), (17, 32), (33, 62)] and one[3] == (15, 0, [(0, 15)], 15)


def test_secrets_base(spark):
    key = "AKIA" + "ABCDEFGH01234567"
    texts = [f'é x password = "hunter22" y token=abc secret:"{"0a" * 15}"', f"{key} AKIA12 x{key}9", "deadbeef" * 3 + " " + "0" * 23,
             "Api_Key : 'abcdef' APIKEY=abcde passwd=token: abcdefgh", None, "", "token=secret=abcdefgh 🙂 " + "f" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = secret_entropy.scan(df).select("doc_id", secret_entropy.text_of(F.filter("spans", lambda s: s["kind_no"] < 3)).alias("s"))
    assert by_id(out, "s") == {i: (brute.secrets(t),) for i, t in enumerate(texts)}


def test_secrets_entropy(spark):
    import math
    import random
    from collections import Counter

    rng = random.Random(5)
    rows = ["".join(rng.choice(secret_entropy.BASE64) for _ in range(60)), "a" * 40, "abcdefghijklmnopqrstuvwxyz",
            "x" * 30 + "".join(rng.choice("0123456789ABCDEF") for _ in range(40)) + "g" * 3, "1234567890" * 4,
            "123e4567-e89b-12d3-a456-426614174000", "some_long/hyphened-words/in_a-path"]
    df = spark.createDataFrame([(i, f"é {s} z") for i, s in enumerate(rows)], "doc_id int, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind_no"] > 2]
           for r in secret_entropy.scan(df).collect()}

    def entropy(s):
        return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())

    size = secret_entropy.WINDOW_SIZE
    for i, s in enumerate(rows):
        for kind, a, z in got[i]:
            limit = secret_entropy.ENTROPY[kind][2]
            assert entropy(s[a - 2:a - 2 + size]) >= limit - 1e-6 and entropy(s[z - 2 - size:z - 2]) >= limit - 1e-6
    assert [k for k, *_ in got[0]] == ["entropy_base64"] and [k for k, *_ in got[3]][-1] == "entropy_hex"
    assert not any(got[i] for i in (1, 2, 4, 5, 6))


def test_edges(empty, clashing, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    for df, n in ((empty, 0), (clashing, 20)):
        assert quality_rules.ledger(df).count() == n
        assert substring_dedup.remove_repeats(df).count() == n
        assert suffix_decontam.find_matches(df, bench).where(F.col(suffix_decontam.Added(df.columns).n_hit) == 0).count() == n
        assert secret_entropy.scan(df).count() == n
