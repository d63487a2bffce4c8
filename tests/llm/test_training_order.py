"""op4's digest comes from the training order that it writes."""

from pyspark.sql import functions as F

from innkeeper.llm import curriculum, queries


def test_digest_follows_the_training_order(spark, tmp_path, monkeypatch):
    rows = [(i, " ".join(["w"] * (i % 7)), "s%d" % (i % 3)) for i in range(60)] + [(None, "a b", None), (5, "a", "s1"), (5, "a", "s1")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    whole = queries.op4_curriculum(spark, str(tmp_path)).collect()
    assert len(whole) == len(rows) and all((r["n_copies"] == 0) == (r["taken"] == 0) for r in whole)
    order = curriculum.training_order
    monkeypatch.setattr(curriculum, "training_order", lambda mixed: order(mixed).where(F.col("copy") == 0))
    first = queries.op4_curriculum(spark, str(tmp_path)).collect()
    assert max(r["n_copies"] for r in first) == 1 and sum(r["taken"] for r in first) < sum(r["taken"] for r in whole)
