"""Rows stay narrow where columns are computed, shuffled or kept."""

import os

from pyspark.sql import functions as F

from innkeeper.functions import jsvalue as js
from innkeeper.operators import records, store
from innkeeper.operators.tables import TableStore
from innkeeper.plans import recovery
from innkeeper.session import checkpoint_root
from innkeeper.sources import bridge, text

SF = "/root/testdata/sf0.001"


def _generated(df) -> list[str]:
    return [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate inline(array(struct(_let" in x]


def test_a_date_is_computed_beside_the_packed_row(spark):
    """Each operator of the date hands on the packed row and its own values, however many columns the row has."""
    df = js.fence(spark.createDataFrame([('"2024-01-02"',), ('"5 March 2021"',), ("null",)], "s string"), x=F.parse_json("s"))
    df = js.fence(df, t=js.vtype(F.col("x")))
    df = js.fence(df, given=js.truthy(F.col("x"), F.col("t")), **{f"c{i}": F.concat("s", F.lit(str(i))) for i in range(40)})
    out = js.with_js_date(df, "at", F.col("x"), F.col("t"), F.col("given"))
    assert _generated(out) and not [x[:200] for x in _generated(out) if "c39" in x]
    assert out.columns == [*df.columns, "at"]
    assert [(r["c39"], str(r["at"])[:10]) for r in out.collect()] == [
        ('"2024-01-02"39', "2024-01-02"), ('"5 March 2021"39', "2021-03-05"), ("null39", "1970-01-01")]


def test_a_load_takes_texts_as_text(spark, tmp_path):
    """The text fields leave the line as text in the walk that takes the other fields: no variant is made of each."""
    staged = TableStore(spark, str(tmp_path)).stage(records.check_lines(bridge.review_lines(spark, SF)), F.lit("j"))
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(reviewComments,StringType" in plan and "StructField(reviewComments,VariantType" not in plan
    assert set(store.REVIEW_TEXT_FIELDS) == set(records.TEXT_FIELDS)


def test_texts_of_any_type(spark):
    values = ['"a"', '""', "1", "1.50", "1e3", "true", "null", '{"a":[1,null]}', "[1,\"x\"]"]
    lines = ['{"reviewTitle":%s}' % v for v in values] + ['{"comment":{"rating":1,"reviewTitle":%s},"reviewTitle":"top"}' % v for v in values]
    df = spark.createDataFrame(list(enumerate([*lines, "{}", "[1]", "null", "x"])), "i int, value string").select(
        F.lit("f").alias("file"), F.struct("i").alias("ord"), "value")
    for policy in (records.LENIENT, records.STRICT):
        for validate in (True, False):
            got = records.check_lines(df, policy, validate).select("str_reviewTitle", js.pg_text(F.col("r_reviewTitle")).alias("plain")).collect()
            assert all(r["str_reviewTitle"] == r["plain"] for r in got), got


def test_errors_joined_and_split_are_those_taken_one_by_one(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "b", "b")], "i int, x string, y string")
    items = [F.col("x"), F.lit(None).cast("string"), F.col("y")]
    assert [r["got"] for r in js.compact_fence(df, "got", items, store.BETWEEN).orderBy("i").collect()] == [["a"], [], ["b", "b"]]


def test_long_texts_are_told_by_characters(spark):
    texts = ["x" * 10, "x" * 11, "é" * 10, "é" * 11, "a\x00", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, translate_target string")
    errs = store._text_errors({"translate_target": 10})
    got = [r["e"] for r in js.compact_fence(df, "e", errs, store.BETWEEN).orderBy("i").collect()]
    long, nul = ["translate_target: longer than 10"], ["translate_target: contains NUL"]
    assert got == [[], long, [], long, nul, []]


def test_a_feed_is_shuffled_without_its_lines(spark, tmp_path, monkeypatch):
    """The range shuffle of a written feed carries the rows its lines are made from; the lines and their order are the same."""
    shuffled = []
    write = text.write_feed
    monkeypatch.setattr(text, "write_feed", lambda rows, *a, **k: (shuffled.append(rows.columns), write(rows, *a, **k)))
    bridge.write_review_feed(spark, SF, f"{tmp_path}/made", parts=3)
    write(bridge.review_lines(spark, SF), f"{tmp_path}/plain", parts=3)
    assert len(shuffled) == 1 and "value" not in shuffled[0]
    made, plain = ([(r["f"], r["value"]) for r in text.read_lines(spark, [f"{tmp_path}/{x}"]).select(
        text.logical_file(F.col("file")).alias("f"), "ord", "value").orderBy("f", "ord").collect()] for x in ("made", "plain"))
    assert made == plain and len(made) > 6000


def test_parts_and_tasks_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = bridge.spread(spark.range(10), "id"), bridge.spread(spark.range(10), "id", rows=bridge.ROWS_A_TASK * cores * 9)
    assert few.rdd.getNumPartitions() == bridge.TASKS_A_CORE * cores and many.rdd.getNumPartitions() == 9 * cores


def test_staged_rows_are_dropped_when_committed(spark, tmp_path):
    tables = TableStore(spark, str(tmp_path))
    lines = records.check_lines(bridge.review_lines(spark, SF))
    tables.apply(lines, "w", 0, F.lit("j"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    folders = os.listdir(tmp_path / "data")
    assert len(folders) == 1 and not [x for x in folders if x.startswith("staged")]
    assert tables.reviews().count() > 0 and [x for x in os.listdir(tmp_path / "data" / folders[0] / "reviews") if x.endswith(".zstd.parquet")]


def test_streams_read_packed_feeds(spark, monkeypatch):
    """The feeds of stream_recovery and stream_progress are packed; what the streams count stays the same."""
    codecs = []
    write = bridge.write_review_feed
    monkeypatch.setattr(bridge, "write_review_feed", lambda *a, **k: (codecs.append(k.get("compression")), write(*a, **k)))
    got = recovery.stream_progress(spark, SF).collect()[0]
    lines = bridge.review_lines(spark, SF).count()
    assert codecs == ["gzip"] and got["total_records"] == lines and got["several_batches"] and checkpoint_root(spark)
