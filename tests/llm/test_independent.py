"""Whole results of op5 and op6 against plain-Python counterparts, and long runs without spaces."""

import time

import numpy as np
import plain

from innkeeper.llm import pii_feistel, queries, secret_entropy, toxicity
from innkeeper.llm.common import table

SF = "/root/testdata/sf0.001"
VALUES = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "4111 1111 1111 1111", "378282246310005",
          "123-45-6789", "666-45-6789", "+49 30 1234567", "(030) 123-4567", "555-123-4567", "192.168.1.254", "300.1.1.1", "1999-12-31",
          "31.12.1999", "29/02/2000", "30/02/2000", "Ann.Bee+x@mail.example.com", "a@b.co", "x@y.c1.org", "x@y.comz@w.org", "a@b.co-x@d.org",
          "a@@b.com", "no@tld", "1234567890123456"]


def test_pseudonyms_equal_a_plain_feistel_network(spark):
    got = {r["doc_id"]: r for r in queries.op6_pii_feistel(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(docs) == len(got)
    kinds = set()
    for d in docs:
        text, found = plain.pseudonymize(d["text"], pii_feistel.PATTERNS, queries.PII_SECRET)
        assert got[d["doc_id"]]["text"] == text
        assert got[d["doc_id"]]["pseudonyms"] == ",".join(f"{k}:{v}" for k, v in found)
        kinds |= {k for k, _ in found}
    assert len(kinds) >= 4


def test_values_one_by_one(spark):
    rows = [(k, f"{a} and {v}, {v}; {b}") for k, v in enumerate(VALUES) for a, b in [("x", "y")]]
    out = pii_feistel.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()
    for r in out:
        text, found = plain.pseudonymize(rows[r["doc_id"]][1], pii_feistel.PATTERNS, "key")
        assert (r["text"], [(f["kind"], f["value"]) for f in r["found"]]) == (text, found)
    of = {VALUES[r["doc_id"]]: {f["kind"] for f in r["found"]} for r in out}
    assert of["DE89 3704 0044 0532 0130 00"] == of["DE89370400440532013000"] == of["GB82 WEST 1234 5698 7654 32"] == {"iban"}
    assert of["x@y.c1.org"] == of["a@b.co"] == {"email"} and not of["300.1.1.1"] and not of["30/02/2000"] and not of["no@tld"]


def long_runs(n):
    return {"dashes": "ab-" * (n // 3), "letters": "q" * n, "labels": "a@b" + ".c1" * (n // 3), "mixed": "aB3+" * (n // 4),
            "digits": "7" * n, "hex": "0123456789abcdef" * (n // 16)}


def test_million_characters_without_a_space(spark):
    """No crash, and time in proportion: a quadratic scan of a million characters would take hours."""
    runs = long_runs(1_000_000)
    df = spark.createDataFrame([(k, f"see {t} end") for k, t in enumerate(runs.values())], "doc_id long, text string").repartition(6)
    start = time.time()
    spans = {r["doc_id"]: r["spans"] for r in secret_entropy.scan(df).collect()}
    out = pii_feistel.pseudonymize(df, "key").collect()
    assert time.time() - start < 200
    kinds = {name: {s["kind"] for s in spans[k]} for k, name in enumerate(runs)}
    assert {n for n, k in kinds.items() if "hex" in k} == {"hex", "digits"}
    assert "entropy_base64" in kinds["hex"] and not kinds["letters"] and not kinds["dashes"]
    assert len(out) == 6 and all(len(r["text"]) >= 1_000_000 - 3 for r in out)


def test_pieces_do_not_change_what_is_flagged(spark, monkeypatch):
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abcABC0123456789+/"), 700)) + "q" * 300 + "".join(rng.choice(list("xyzXYZ567"), 200)) for _ in range(6)]
    texts += ["ab-cd-" * 100, "A1b2" * 6, "z" * 23 + "0", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r["doc_id"]: r["spans"] for r in secret_entropy.scan(df).collect()}
    monkeypatch.setattr(secret_entropy, "PIECE", 7)
    assert {r["doc_id"]: r["spans"] for r in secret_entropy.scan(df).collect()} == whole


def test_scores_equal_a_plain_forward_pass(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    model = toxicity.learn(docs, labels)
    p = {k: v.astype(float).tolist() for k, v in model.p.items()}
    got = {r["doc_id"]: r for r in queries.op5_toxicity(spark, SF).collect()}
    cache = {}

    def vector(word):
        """The word's own embedding and the mean of those of its trigrams."""
        if word not in cache:
            marked = b"<" + word + b">"
            codes = [int.from_bytes((marked + b">")[k:k + 3], "little") for k in range(len(word) + 1)]
            shift = 32 - (toxicity.TRIGRAMS.bit_length() - 1)
            rows = [p["chars"][(c * 2654435761 % (1 << 32)) >> shift] for c in codes]
            cache[word] = p["words"][model.vocabulary.get(word, 0)] + [sum(x) / len(rows) for x in zip(*rows)]
        return cache[word]

    chosen = sorted(docs.collect(), key=lambda d: len(d["text"] or ""))
    for d in chosen[:4] + chosen[60:65]:
        words = [toxicity.bare(w) for w in (d["text"] or "").encode().lower().split()]
        n = len(words)
        starts = [0] if n <= toxicity.STEPS else [*range(0, n - toxicity.STEPS, toxicity.STRIDE), n - toxicity.STEPS]
        best = max(plain.window_logit([vector(w) for w in words[s:s + toxicity.STEPS]], p) if n else p["bias"][0] for s in starts)
        score = 1 / (1 + np.exp(-best))
        assert abs(got[d["doc_id"]]["score"] - score) < 2e-3, (d["doc_id"], score)
        assert got[d["doc_id"]]["predicted"] == int(got[d["doc_id"]]["score"] >= 0.7)
