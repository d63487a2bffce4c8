"""Toxicity model, and the pipeline against a plain composition of brute-force stages."""

import hashlib
import math
import random

import brute
import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from innkeeper.llm import curriculum, toxicity

SF = "/root/testdata/sf0.001"
MEAN = ["vilex", "grobot", "snarlik"]


def sample(n, seed, flip=0.05):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(300)}o" for _ in range(rng.randrange(20, 160))]
        toxic = rng.random() < 0.25
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(MEAN)
        rows.append((" ".join(words).encode(), int(toxic), int(toxic) ^ (rng.random() < flip)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = sample(400, 1)
    return toxicity.fit([t for t, _, _ in rows], [y for *_, y in rows])


def test_held_out_accuracy_with_flipped_labels(model):
    rows = sample(300, 2, flip=0)
    score = toxicity.Scorer(model).score([t for t, *_ in rows])
    truth = np.array([y for _, y, _ in rows])
    assert ((score >= toxicity.REJECT_AT) == truth).mean() > 0.97


def test_every_window_is_scored(model):
    rng = random.Random(9)
    clean = [f"{rng.choice('abcdefgh')}{rng.randrange(300)}o" for _ in range(5000)]
    texts = [clean]
    for at in (0, 2500, 4999):
        texts.append(clean[:at] + ["VILEX,", "grobot!!"] + clean[at:])
    score = toxicity.Scorer(model).score([" ".join(t).encode() for t in texts])
    assert score[0] < 0.7 <= score[1:].min()
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        starts = toxicity.window_starts(n)
        assert set(range(n)) <= {i for s in starts for i in range(s, s + toxicity.STEPS)}
        assert all(0 < b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_fast_path_equals_plain_network(model):
    words = [toxicity.bare(w) for w in b"a1o vilex b2o zzz grobot h9o <> ''".split()]
    gates = model.gates(model.inputs(words))
    rng = np.random.default_rng(0)
    ids = rng.integers(0, len(words), (50, toxicity.STEPS)).astype(np.int32)
    ids[3, 5:] = -1
    ids[4] = -1
    h3, part, mask = 3 * toxicity.HIDDEN, np.maximum(ids, 0).T, (ids >= 0).T
    f = toxicity.gru(gates[part][..., :h3], mask, model.p["state_f"])
    b = toxicity.gru(gates[part][::-1, :, h3:], mask[::-1], model.p["state_b"])[::-1]
    plain = toxicity.pooled(model.p, np.concatenate([f, b], 2), mask)[0]
    assert np.allclose(plain, toxicity.window_logits(model, toxicity.split_gates(gates), ids), atol=1e-4)


def test_gradients_by_differences():
    known = [b"alpha", b"beta", b"gamma", b""]
    m = toxicity.Model([b"alpha", b"beta"], np.array([4.0, -3.0]), seed=3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    own = np.array([1, 2, 0, 0])
    ids = np.array([[0, 1, 2, 1, 0, 3] + [-1] * 26, [2] * 20 + [0] * 12], np.int32)
    y, weight = np.array([1.0, 0.0]), np.array([0.7, 1.2])

    def loss():
        gates = m.gates(m.inputs(known))
        h3, part, mask = 3 * toxicity.HIDDEN, np.maximum(ids, 0).T, (ids >= 0).T
        f = toxicity.gru(gates[part][..., :h3], mask, m.p["state_f"])
        b = toxicity.gru(gates[part][::-1, :, h3:], mask[::-1], m.p["state_b"])[::-1]
        s = toxicity.sigmoid(toxicity.pooled(m.p, np.concatenate([f, b], 2), mask)[0])
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).mean()

    g = toxicity.gradients(m, ids, y, weight, known, own, robust=False)
    for name, grad in g.items():
        place = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        keep, step = m.p[name][place], 2e-2
        m.p[name][place] = keep + step
        up = loss()
        m.p[name][place] = keep - step
        down = loss()
        m.p[name][place] = keep
        assert abs((up - down) / (2 * step) - grad[place]) < 0.05 * abs(grad[place]) + 2e-4, name


def test_learn_and_score_edges(spark, corpus, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.learn(docs, none) == 0.0
    one = spark.createDataFrame([(i, 1, 1) for i in range(20)] + [(None, 1, 0), (5, 1, None)], none.schema)
    assert toxicity.learn(docs, one) == 1.0
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], none.schema)
    m = toxicity.learn(docs, labels)
    scored = toxicity.score_documents(docs, m)
    assert scored.columns == [*docs.columns, "_score"] and scored.where("_score BETWEEN 0 AND 1").count() == len(corpus)
    blank = {r["_score"] for r in scored.where("text IS NULL OR text = ''").collect()}
    assert len(blank) == 1
    assert toxicity.score_documents(empty, m).count() == 0
    again = {r["doc_id"]: r["_score"] for r in toxicity.score_documents(docs, toxicity.learn(docs, labels)).collect()}
    assert all(abs(again[r["doc_id"]] - r["_score"]) < 1e-6 for r in scored.collect())


def mixed_times(docs):
    """{id: times of the copies that count} by the curriculum's rules, in plain Python."""
    sizes = {i: len(brute.words(t)) for i, t, s in docs}
    totals = {}
    for i, _, s in docs:
        totals[s] = totals.get(s, 0) + sizes[i]
    from test_tables import fill

    target, out = fill(totals), {}
    for s in totals:
        order = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i, _, x in docs if x == s)
        at = 0
        for _, i in order:
            whole, out[i] = int(target[s] + 1e-9), []
            for begin in (at, at + totals[s]):
                got = max(0, min(whole - begin, sizes[i]))
                if got > 0 and 2 * got >= sizes[i]:
                    # The weight grows from 0.5 to 1.5: words / target = t / 2 + t^2 / 2.
                    out[i].append(min(math.sqrt(0.25 + 2 * min(begin / target[s], 1.0)) - 0.5, 1.0))
            at += sizes[i]
    return out


def mixed_copies(docs):
    return {i: len(t) for i, t in mixed_times(docs).items()}


def test_run_equals_brute_force(spark):
    from innkeeper.llm.common import table

    con = duckdb.connect()
    docs = con.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    items = con.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    model = toxicity.learn(table(spark, SF, "documents"), table(spark, SF, "labels"))
    score = toxicity.Scorer(model).score([(t or "").encode() for _, t, _ in docs])
    left = [d for d, s in zip(docs, score) if s < toxicity.REJECT_AT]
    assert len(left) < len(docs)
    component = brute.near_duplicates([(i, t) for i, t, _ in left])
    left = [d for d in left if component[d[0]] == d[0]]
    left = [d for d, c in zip(left, brute.contamination([t for _, t, _ in left], items)) if not c[4]]
    texts = {i: t for i, t, _ in left}
    order = sorted((time, i) for i, times in mixed_times(left).items() for time in times)
    assert [i for _, i in order] != sorted(i for _, i in order)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for _, i in order:  # the tokens lie in training order
        (_, _, n, crc), = brute.token_rows([(i, texts[i])], tokenizer)
        want.append((i, start, n, crc))
        start += n
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]
    assert got == want


def test_stages_at_the_edges(spark, docs, empty, clashing, corpus):
    nulls = spark.createDataFrame([(None, None, None, None, None), (None, "some words here", None, "s1", 1),
                                   (3, corpus[3][1], "en", None, 0)], docs.schema)
    for df in (empty, clashing, nulls, docs.union(nulls)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF)
            if name != "tokens":
                assert out.columns == df.columns, name
            rows = out.collect()
            if name in ("toxicity", "near_duplicates", "decontamination"):
                assert len(rows) <= df.count()


def test_one_of_each_group_stays(spark, docs, corpus):
    left = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    component = brute.near_duplicates([(i, t) for i, t, *_ in corpus])
    assert left == {i for i in component if component[i] == i}


def test_mix_repeats_and_drops_whole_documents(spark, docs, corpus):
    out = corpus_pipeline.mix_sources(spark, docs, SF)
    got = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    want = mixed_copies([(i, t, s) for i, t, _, s, _ in corpus])
    assert got == {i: n for i, n in want.items() if n}
    assert curriculum.EPOCHS == max(got.values())
