import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, alphabet=400):
    return " ".join(f"w{rng.randrange(alphabet)}x" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows of documents: prose, exact and near copies, shared passages, nulls, empties, a long text."""
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(1, 200)) for _ in range(30)]
    texts += texts[:5] + [texts[0]] * 6
    base = prose(rng, 150, 4000).split()
    for k in range(12):
        copy = list(base)
        for _ in range(k):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10 ** 6)}"
        texts.append(" ".join(copy))
    passage = prose(rng, 60, 4000)
    texts += [f"{prose(rng, 40, 4000)} {passage} {prose(rng, 30, 4000)}" for _ in range(8)]
    texts += [f"{passage} {passage}", prose(rng, 12000, 10 ** 6), None, "", " \n\t", "one", "One", "Two words", "two words",
              "Éa ébc é*** # # !! ## a\n\na\n b \na", "x\r\ny\x0bz\x0c", "same same same same same same same"]
    return [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing(spark, corpus):
    """Further columns whose names the operators use themselves."""
    names = ("n_words", "kept", "score", "size", "key", "id", "block", "part", "root", "taken", "start", "rule", "found", "spans",
             "_score", "_hits", "_items", "_n_words", "_n_hit", "_longest", "_kept", "_id", "_times", "_time", "_key", "_text", "_pieces",
             "_found", "_s", "_order", "_cell", "_w", "_n", "_h", "_p", "place", "file", "row")
    df = spark.createDataFrame(corpus[:20], SCHEMA)
    for name in names:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df
