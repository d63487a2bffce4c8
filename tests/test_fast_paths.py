"""The compiled ways of the parse and the store give what the plain expressions give."""

import re

from pyspark.sql import functions as F

from innkeeper.functions import jsvalue as js
from innkeeper.operators import records, store
from innkeeper.operators.tables import TableStore
from innkeeper.plans.catalog import QUERIES
from innkeeper.sources import bridge, text

DATES = ['"2024-01-02"', '"2024-01-02T03:04:05,5Z"', '" 5 March 2021 "', '"MAR 5, 2021 10:00 PM EST"', '"Sat, 03 Feb 1996 00:00:00 GMT"',
         '"12:30"', '"not a date"', '"İ 2020"', '"1/31/99"', '""', "0", "86400000", "1e30", "-5.5", "true", "false", "null", "[1]", "{}", '"K 2020"']


def test_date_by_fences(spark):
    df = js.fence(spark.createDataFrame([(x,) for x in DATES], "s string"), x=F.parse_json("s"))
    df = js.fence(df, t=js.vtype(F.col("x")))
    df = js.fence(df.unionByName(df.limit(1).select("s", F.lit(None).cast("variant").alias("x"), F.lit(None).cast("string").alias("t"))),
                  given=js.truthy(F.col("x"), F.col("t")))
    both = js.with_js_date(df, "now", F.col("x"), F.col("t"), F.col("given")).select("s", "now", js.js_date(F.col("x"), F.col("t")).alias("plain"))
    rows = both.collect()
    assert len(rows) == len(DATES) + 1 and all(r["now"] == r["plain"] for r in rows), rows


def test_generators_hold_no_lambda(spark):
    """A generator with a lambda function in it is interpreted whole: the parse keeps them in projections."""
    plan = QUERIES["store_counters"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    generators = [x for x in plan.splitlines() if "Generate " in x]
    assert generators and not [x[:300] for x in generators if "lambdafunction" in x]


def test_feed_is_dealt_over_several_tasks_a_core(spark):
    df = bridge.spread(spark.range(10))
    assert df.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_members_of_what_is_no_object(spark):
    lines = ["null", "[1]", '"a"', '{"comment":[1]}', '{"comment":"x","rating":1}', '{"comment":null}', '{"comment":{"rating":null},"rating":3}']
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, i int, value string").select("file", F.struct("i").alias("ord"), "value")
    for policy in (records.LENIENT, records.STRICT):
        for validate in (True, False):
            got = records.check_lines(df, policy, validate).orderBy("ord").select(F.to_json("r_rating").alias("r")).collect()
            flat = policy == records.STRICT and not validate
            in_comment = policy == records.STRICT and validate
            assert [r["r"] for r in got] == [None, None, None, None, None if in_comment else "1", None, "3" if flat else "null"]


def test_packed_feed_reads_as_the_plain_one(spark, tmp_path):
    rows = [("a" if i % 3 else "b", i, f'{{"n":{i},"x":"{"y" * 50}"}}') for i in range(2000)]
    feed = spark.createDataFrame(rows, "file string, i int, value string").select("file", F.struct("i").alias("ord"), "value")
    size, seen = {}, {}
    for codec in (None, "gzip"):
        root = tmp_path / str(codec)
        text.write_feed(feed, str(root), compression=codec)
        size[codec] = sum(p.stat().st_size for p in root.rglob("part-*"))
        lines = text.read_lines(spark, [str(root)]).select(text.logical_file(F.col("file")).alias("f"), "ord", "value")
        seen[codec] = [(r["f"], r["value"]) for r in lines.orderBy("f", "ord").collect()]
    assert seen[None] == seen["gzip"] and len(seen[None]) == len(rows)
    assert size["gzip"] < size[None] / 3


def test_file_runs_keep_a_packed_feed(spark):
    from innkeeper.plans import streams
    root, _ = streams._file_state(spark, "/root/testdata/sf0.001")
    assert spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/feed").where("path NOT LIKE '%.txt.gz'").isEmpty()


def test_no_generated_method_is_too_long_for_the_jvm(spark, tmp_path):
    """The JVM leaves a method of more than 8,000 bytes interpreted; the checks and projections of a line stay below."""
    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # the code of an adaptive plan is not known before it runs
    try:
        checked = records.check_lines(bridge.review_lines(spark, sf))
        job = bridge.request_job_id(F.col("file"))
        frames = {"store_counters": QUERIES["store_counters"](spark, sf), "stage": TableStore(spark, str(tmp_path)).stage(checked, job),
                  "review_rows": store.review_rows(checked.filter("is_valid"), job), "hotel_rows": store.hotel_rows(checked.filter("is_valid"))}
        debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
        for name, df in frames.items():
            stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
            sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
            assert sizes and max(sizes) <= 8000, (name, sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_line_with_its_own_sentinel_or_an_escaped_name(spark):
    """What is looked for only where a line may have it: a sentinel of the line's own, a comment spelled by escapes."""
    lines = ['1,"§"', '1,"\\u00a7"', '"§"', '"\\u00a7"', '{"a":"§"}', '{"comm\\u0065nt":{"rating":1}}', '{"comment" : {"rating":2}}',
             '{"x":"\\n","rating":3}', '{"reviewComments":"c","rating":4}', '{"comment":null,"rating":5}', '1] x']
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, i int, value string").select("file", F.struct("i").alias("ord"), "value")
    plain = js.fence(df, _w=js.strict_wrap(F.col("value"))).select("ord", js.strict_ok(F.col("_w")).alias("plain"))
    got = records.check_lines(df).join(plain, "ord").orderBy("ord").select("parsed", "plain", "raw", F.to_json("r_rating").alias("r"), "errors").collect()
    assert [r["parsed"] for r in got] == [r["plain"] for r in got] == [False, False] + [True] * 8 + [False]
    assert [r["raw"] for r in got] == [i in (5, 6) for i in range(len(lines))]
    assert [r["r"] for r in got][5:10] == ["1", "2", "3", "4", "5"]
    assert got[9]["errors"] == [records.MSG_COMMENT_NULL]


def test_types_that_nobody_reads_are_not_computed(spark):
    plan = QUERIES["ingest_file_counts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "t_rating" in plan and "t_isShowReviewResponse" not in plan and "b_reviewDate" not in plan


def test_lines_are_dealt_after_the_joins(spark):
    """A shuffle join leaves about as many tasks as cores; the parse above it has several a core, however large the feed."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = bridge.review_lines(spark, "/root/testdata/sf0.001")
        plan = lines._jdf.queryExecution().optimizedPlan().toString()
        assert lines.rdd.getNumPartitions() == bridge.TASKS_A_CORE * spark.sparkContext.defaultParallelism
        assert plan.index("Repartition") < plan.index("Join")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_members_that_nobody_reads_are_not_taken(spark):
    plan = lambda name: QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    for name in ("ingest_file_counts", "valid_records", "valid_no_rules", "strict_no_rules", "hotels_merge"):
        assert not [n for n in ("reviewComments", "reviewTitle", "encryptedReviewData") if f"StructField({n}," in plan(name) or f"r_{n}" in plan(name)], name
    custom = plan("custom_rules")
    assert custom.count("try_variant_get(_w") <= 2 and "r_reviewTitle" in custom and "r_reviewComments" not in custom
    assert "r_reviewComments" in plan("flattened_reviews") and "r_reviewTitle" in plan("flattened_reviews")


def test_a_rule_need_not_name_the_fields_it_reads(spark):
    rows = [(i, x) for i, x in enumerate(['{"comment":{"rating":1,"reviewTitle":"a"}}', '{"reviewTitle":""}', '{"comment":{"rating":1}}', "[1]", '{"reviewTitle":0.5}'])]
    df = spark.createDataFrame(rows, "i int, value string").select(F.lit("f").alias("file"), F.struct("i").alias("ord"), "value")
    for policy in (records.LENIENT, records.STRICT):
        one, two = ([tuple(r) for r in records.check_lines(df, policy, rules=[records.Rule("title", lambda rec: ~js.truthy(rec["reviewTitle"]), reads=reads)])
                     .orderBy("ord").select("errors", "is_valid", F.to_json("r_reviewTitle")).collect()] for reads in ((), ("reviewTitle",)))
        assert one == two and one[0][1] is True and one[2][0] == ["title"]


def test_a_comment_that_is_no_object(spark):
    lines = ['{"comment":null}', '{"comment":"x"}', '{"comment":[1]}', '{"comment":7}', '{"a":1}', "null", "[1]", '"a"', '1,{"§":{}}', '1] x', "{} {}"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string").select(F.lit("f").alias("file"), F.struct("i").alias("ord"), "value")
    got = {p: [r["_pre"] for r in records.check_lines(df, p, rules=[]).orderBy("ord").select(F.get("errors", F.lit(0)).alias("_pre")).collect()]
           for p in (records.LENIENT, records.STRICT)}
    bad, none = [records.MSG_PARSE] * 3, records.MSG_STRICT_NO_COMMENT
    assert got[records.LENIENT] == [records.MSG_COMMENT_NULL, None, None, None, None, records.MSG_NULL_RECORD, None, None, *bad]
    assert got[records.STRICT] == [none, None, None, None, none, records.MSG_STRICT_NULL, none, none, *bad]


def test_few_and_many_items_are_compacted_alike(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "b", "b")], "i int, x string, y string")
    few = [F.col("x"), F.lit(None).cast("string"), F.col("y")]
    many = few + [F.lit(None).cast("string")] * js.FEW_ITEMS
    for items in (few, many):
        assert [r["got"] for r in js.compact_fence(df, "got", items).orderBy("i").collect()] == [["a"], [], ["b", "b"]]


def test_a_value_is_taken_from_its_variant_once(spark):
    """Spark builds a cast for each value taken, and a generator takes it as often as its expressions name it."""
    checked = records.check_lines(bridge.review_lines(spark, "/root/testdata/sf0.001")).filter("is_valid")
    plan = store.hotel_rows(checked)._jdf.queryExecution().optimizedPlan().toString()
    for field, kind in (("hotelId", "DoubleType"), ("_score", "DoubleType"), ("platform", "StringType")):
        name = field if field[0] == "_" else f"r_{field}"
        assert len(re.findall(rf"variant_get\({name}#\d+, \$, {kind}, (?:true|false)", plan)) <= (2 if kind == "StringType" else 1), (field, plan[:500])


def test_rows_are_dealt_by_their_keys(spark):
    """Round-robin dealing sorts all rows of a task first; keys that tell rows apart need no sort."""
    lines = bridge.review_source(spark, "/root/testdata/sf0.01")
    assert "RepartitionByExpression [l_orderkey" in lines._jdf.queryExecution().optimizedPlan().toString()
    sizes = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == bridge.TASKS_A_CORE * spark.sparkContext.defaultParallelism and max(sizes) < 1.3 * sum(sizes) / len(sizes)
