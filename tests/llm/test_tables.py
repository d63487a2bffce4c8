"""Near duplicates, token files, mixing, URL rules, pseudonyms: against brute force and at the edges."""

import random

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from innkeeper.llm import curriculum, minhash_dedup, pii_feistel, token_files, url_rules
from innkeeper.llm.components import absorb
from innkeeper.session import scratch_path


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_near_duplicates(docs, corpus):
    want = brute.near_duplicates([(i, t) for i, t, *_ in corpus])
    got = by_id(minhash_dedup.near_duplicates(docs), "n_shingles", "component_id", "kept")
    assert got == {i: (len(brute.shingles(t)), want[i], want[i] == i) for i, t, *_ in corpus}
    assert len(set(want.values())) < len(want) - 15


def test_chain_of_copies(spark):
    """Neighbours are linked, ends are not: one component all the same."""
    rng = random.Random(11)
    words = [f"c{rng.randrange(10 ** 6)}" for _ in range(200)]
    rows = []
    for k in range(25):
        rows.append((100 - k, " ".join(words)))
        words = words[4:] + [f"n{rng.randrange(10 ** 6)}" for _ in range(4)]
    rows += [(7, " ".join(f"o{rng.randrange(10 ** 6)}" for _ in range(100)))]
    got = by_id(minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "component_id")
    assert got == {i: (c,) for i, c in brute.near_duplicates(rows).items()}
    assert got[100] == (76,)


def test_half_alike_texts_share_buckets_but_no_link(spark):
    """Many texts around a long common passage: full buckets, judged pair by pair."""
    rng = random.Random(2)
    common = [f"k{i}" for i in range(120)]
    rows = [(i, " ".join(common + [f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(15, 60))])) for i in range(60)]
    got = by_id(minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "component_id")
    assert got == {i: (c,) for i, c in brute.near_duplicates(rows).items()}


def test_near_duplicates_null_and_repeated_keys(spark):
    text = " ".join(f"a{i}" for i in range(30))
    df = spark.createDataFrame([(5, text), (5, text), (9, text), (None, text), (None, None)], "doc_id long, text string")
    rows = sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(df).collect())
    assert rows == [(-1, None, True), (-1, None, True), (5, 5, True), (5, 5, True), (9, 5, False)]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    first = absorb(None, spark.createDataFrame(links[:150], "a long, b long"))
    labels = {r["node"]: r["root"] for r in absorb(first, spark.createDataFrame(links[150:], "a long, b long")).collect()}
    assert all(labels.get(v, v) == find(v) for v in list(root))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_files(spark, docs, corpus, name):
    file = public_tokenizers.path(name)
    path = scratch_path(spark, "test-tokens")
    extra = [(-1, "a\tb\nc\x0bd\x0ce\rf g'll <|endoftext|> x\u00a0y\u2003z e\u0301 \u0301x ΑΣ Σ \x1c!\x1c", "en", "s", 0)]
    token_files.write_tokens(docs.union(spark.createDataFrame(extra, docs.schema)), path, file)
    got = token_files.checksums(token_files.read_tokens(spark, path)).collect()
    want = brute.token_rows([(i, t) for i, t, *_ in corpus + extra], Tokenizer.from_file(file))
    assert sorted((r["key"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(want)


def test_selective_reads(spark, docs, corpus):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    few = token_files.read_tokens(spark, path, F.col("key").between(10, 12))
    whole = {r["key"]: r for r in token_files.read_tokens(spark, path).collect()}
    assert {r["key"]: r for r in few.collect()} == {k: whole[k] for k in (10, 11, 12)}
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(key,10)" in plan
    lean = token_files.read_tokens(spark, path, ids=False)
    assert "ids:array" not in lean._jdf.queryExecution().executedPlan().toString()


def test_token_file_layout(spark, docs):
    import glob

    import pyarrow.parquet as pq

    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            ids = next(meta.row_group(g).column(c) for c in range(meta.num_columns) if "ids" in meta.row_group(g).column(c).path_in_schema)
            assert any("DICTIONARY" in e or "DELTA" in e for e in ids.encodings)
            assert ids.has_offset_index and ids.has_column_index


def fill(sizes, weights=(3, 1, 2)):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * left / total > 2 * sizes[s]]
        if not over:
            return full | {s: weight[s] * left / total for s in open_}
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


def test_mixing(docs, corpus):
    got = curriculum.mix(curriculum.sized(docs, "doc_id", "source")).collect()
    sizes = {}
    for _, t, _, s, _ in corpus:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = fill(sizes)
    for s in sizes:
        rows = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - want[s]) < 1e-6 and r["source_size"] == sizes[s] for r in rows)
        assert abs(sum(r["taken"] for r in rows) - want[s]) < 1
    for r in got:
        assert r["size"] == len(brute.words(corpus[r["doc_id"]][1]))
        assert 0 <= r["taken"] <= 2 * r["size"] and sum(r["words_each"]) == r["taken"]
        assert all(0 <= t <= 1 for t in r["times"])


def test_targets_random(spark):
    rng = random.Random(8)
    for _ in range(4):
        sizes = {f"s{k}": rng.choice([0, 1, 10, 1000, 50000]) * rng.randrange(1, 9) for k in range(rng.randrange(1, 12))}
        rows = curriculum.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
        want = fill(sizes)
        assert all(abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]) for r in rows)


def test_schedule_follows_the_ramp(spark):
    """By half time a source has had the integral of its weight up to there."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(10).cast("long").alias("size"))
    order = curriculum.training_order(curriculum.mix(df)).collect()
    times = [r["time"] for r in order]
    assert times == sorted(times)
    half = sum(r["words"] for r in order if r["time"] < 0.5) / sum(r["words"] for r in order)
    assert abs(half - (0.5 * 0.5 + 0.5 * 0.25)) < 0.01


URLS = ["http://a.example.net/en/x?q=/de/", "https://EXAMPLE.com/de/1#x", "ftp://net/", "net/x", None, "http://net", "http://x.net?y",
        "http://example.org/fr/", "http://example.org/fr", "http://notnet/", "http://a.b.c.net//", "x://y://net/", "http://u@net:80/", "://net/"]


def plain_verdict(url):
    import re

    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = brute.low(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = [(len(h + p), h + p, a) for a, h, p in (("block", "net", "/"), ("allow", "example.net", "/en/"),
            ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_url_rules(spark):
    from innkeeper.llm.queries import URL_RULES

    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[:3])], "page_id int, url string, verdict string")
    out = url_rules.judge_urls(pages, spark.createDataFrame(URL_RULES, url_rules.RULE_SCHEMA))
    got = {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got == {i: plain_verdict(u) for i, u in enumerate(URLS + URLS[:3])}


def test_url_rules_general(spark):
    rules = spark.createDataFrame([("block", "a.b", "/x"), ("allow", "a.b", "/x/y.html"), ("block", "a.b", "/x/y.html")], url_rules.RULE_SCHEMA)
    pages = spark.createDataFrame([(0, "h://a.b/xyz"), (1, "h://a.b/x/y.html"), (2, "h://a.b/y")], "page_id int, url string")
    got = {r["row"]["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judge_urls(pages, rules).collect()}
    assert got == {0: ("a.b/x", "block"), 1: ("a.b/x/y.html", "block"), 2: (None, "allow")}
    assert url_rules.judge_urls(pages, rules.limit(0)).where("verdict = 'allow' AND rule IS NULL").count() == 3


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def test_pseudonyms(spark):
    import datetime
    import re

    texts = ["card 4111111111111111, 4111 1111 1111 1111 and 4111111111111112; 5 4111111111111111",
             "on 2024-02-29, 31.12.1999, 13/13/2000 and 2024-02-29", "ssn 123-45-6789 000-12-3456 666-11-1111",
             "DE89370400440532013000 DE89370400440532013001", "+1 (487) 555-7209 rest", "10.0.0.1 300.1.1.1 10.0.0.1.5",
             "Bob.X@Ex.com bob.x@ex.com", None, "", "no values at all", "é 4111111111111111 é", "212-555-0147 1-212-555-0147"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = {r["doc_id"]: r for r in pii_feistel.pseudonymize(df, "k").collect()}
    cards = re.findall(r"[0-9 ]{16,19}", out[0]["text"].replace("card ", ""))
    assert all(luhn(f["value"].replace(" ", "")) for f in out[0]["found"]) and len(out[0]["found"]) == 3 and cards
    assert "4111111111111112" in out[0]["text"] and "4111111111111111" not in out[0]["text"]
    assert out[0]["found"][0]["value"] == out[0]["found"][2]["value"] == out[10]["found"][0]["value"]
    dates = [f["value"] for f in out[1]["found"]]
    assert len(dates) == 3 and dates[0] == dates[2] and "13/13/2000" in out[1]["text"]
    assert datetime.date.fromisoformat(dates[0]) and datetime.datetime.strptime(dates[1], "%d.%m.%Y")
    assert "000-12-3456" in out[2]["text"] and "666-11-1111" in out[2]["text"] and "123-45-6789" not in out[2]["text"]
    iban = out[3]["found"][0]["value"]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and len(out[3]["found"]) == 1
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4} rest", out[4]["text"]) and "487" not in out[4]["text"]
    assert "300.1.1.1 10.0.0.1.5" in out[5]["text"] and not out[5]["text"].startswith("10.0.0.1 ")
    assert [f["value"].split("@")[0] for f in out[6]["found"]] == [out[6]["found"][0]["value"].split("@")[0]] * 2
    assert len(out[11]["found"]) == 1 and out[11]["text"].endswith(" 1-212-555-0147") and not out[11]["text"].startswith("212")
    assert out[7]["text"] is None and out[8]["text"] == "" and out[9]["text"] == texts[9]


def test_feistel_permutes(spark):
    """No two values of a small format meet, and the layout of the format is kept."""
    df = spark.range(10_000).select(F.format_string("%04d", "id").alias("d"))
    p = df.select(pii_feistel.permuted_digits(F.col("d"), "k", F.lit("t")).alias("p"))
    assert p.distinct().where(F.length("p") == 4).count() == 10_000
    days = spark.range(146_097).select(pii_feistel.permuted(F.floor(F.col("id") / 773), F.col("id") % 773, F.lit(189), F.lit(773), "k", F.lit("d")).alias("x"))
    assert days.select("x.*").distinct().where("a BETWEEN 0 AND 188 AND b BETWEEN 0 AND 772").count() == 146_097


def test_edges(empty, clashing, spark):
    for df, n in ((empty, 0), (clashing, 20)):
        assert minhash_dedup.near_duplicates(df).count() == n
        path = scratch_path(spark, "test-tokens")
        token_files.write_tokens(df, path, public_tokenizers.path("word_bpe_49k.json"))
        assert token_files.read_tokens(spark, path).count() == n
        assert curriculum.mix(curriculum.sized(df, "doc_id", "source")).count() == n
        assert pii_feistel.pseudonymize(df, "k").count() == n
