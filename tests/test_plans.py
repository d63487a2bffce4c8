"""Physical-plan shape of the headline queries (what .explain showed when tuning)."""

import re

from innkeeper.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = QUERIES[name](spark, SF)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_scans_are_pruned_and_no_python_udfs(spark):
    plan = _plan(spark, "store_counters")
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas, plan[:2000]
    lineitem = [s for s in schemas if "l_orderkey" in s][0]
    # 8 of lineitem's 11 columns are read
    assert lineitem.count(":") == 8 and "l_extendedprice" not in lineitem
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_keyed_dedupe_combines_before_the_shuffle(spark):
    plan = _plan(spark, "reviews_insert")
    # partial aggregate (map-side) below the exchange on the key, final above it
    assert re.search(r"partial_min", plan)
    assert re.search(r"Exchange[^\n]*\n[^\n]*hashpartitioning\(hotel_review_id", plan) or \
        "hashpartitioning(hotel_review_id" in plan


def test_top_k_is_take_ordered(spark):
    plan = _plan(spark, "jobs_by_status")
    assert "TakeOrderedAndProject" in plan
    assert "Sort " not in plan.split("TakeOrderedAndProject")[0]


def test_json_parsed_once_per_line(spark):
    df = QUERIES["store_counters"](spark, SF)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("parseJson") + optimized.count("parse_json") <= 1


def test_stored_reads_push_their_filter(spark):
    for name, pushed in (("point_lookup", "EqualTo(hotel_id,1)"), ("review_lookup", "EqualTo(hotel_review_id,15)"),
                         ("newest_reviews_by_hotel", "EqualTo(hotel_id,1)"), ("newest_reviews_by_platform", "EqualTo(platform,agoda)"),
                         ("hotel_filters", "GreaterThanOrEqual(review_count,5)")):
        plan = _plan(spark, name)
        assert pushed in plan, name
        assert "parse_json" not in plan and "lineitem" not in plan


def test_page_totals_are_counted_with_the_page(spark):
    plan = _plan(spark, "jobs_page")
    assert "Subquery" in plan and "TakeOrderedAndProject" in plan


def test_dedupe_sorts_no_text(spark):
    """The aggregate that finds a key's first row carries the key and the order alone."""
    plan = _plan(spark, "reviews_insert")
    agg = re.findall(r"\(\d+\) (?:Sort|Hash|ObjectHash)Aggregate[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert agg and all("review_title" not in x for x in agg)
