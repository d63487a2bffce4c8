"""Registered ledger, admission, read and join queries.

Reviews / hotels come from the ingest of the review feed (plans.ingest); the job
ledger comes from orders (sources.bridge.jobs_source).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger, reads, records
from ..operators.tables import TableStore
from ..session import ensure_conf, scratch_path
from ..sources import bridge
from . import ingest

NOW = "2025-06-01 00:00:00"     # "now" of the ledger transition query (fixed)
LOOKUP_HOTEL_ID = 1
LOOKUP_REVIEW_ID = 15
LOOKUP_JOB_FILE = "orders/7.jl"
PAGE_LIMIT, PAGE_OFFSET = 10, 20


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return bridge.jobs_source(spark, sf_dir)


_LOADED: dict = {}


def loaded(spark: SparkSession, sf_dir: str) -> TableStore:
    """The store after one load of the review feed, loaded once in a session: what the reads run on."""
    ensure_conf(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        tables = TableStore(spark, scratch_path(spark, "loaded"))
        lines = records.check_lines(bridge.review_lines(spark, sf_dir))
        tables.apply(lines, "feed", sf_dir, bridge.request_job_id(F.col("file")), F.lit(ingest.RUN_TS).cast("timestamp_ntz"))
        _LOADED[key] = tables
    return _LOADED[key]


def _reviews(spark, sf_dir):
    return loaded(spark, sf_dir).reviews()


def _hotels(spark, sf_dir):
    return loaded(spark, sf_dir).hotels()


# -- admission / multi-file ---------------------------------------------------

def file_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q02: admission decision per ingest request against an object listing."""
    ensure_conf(spark)
    return ledger.admission(bridge.admission_requests(spark, sf_dir), bridge.object_listing(spark, sf_dir))


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows of the load of the review feed: one job per file, with the load's counts.

    Driven from the requests (left join), so a requested file without lines has a row too.
    """
    counts = loaded(spark, sf_dir).counters("feed", sf_dir)
    requests = spark.range(bridge.N_FILES + 1).select(
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("filepath"),
        F.lit(bridge.REQUEST_PLATFORM).alias("platform"), F.lit("local").alias("storage_provider"))
    return ledger.with_job_ids(requests).join(counts.drop("file"), "job_id", "left").select(
        "job_id", "filepath", "platform",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ledger.COUNTS])


# -- ledger ---------------------------------------------------------------------

def job_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: deterministic job id per request."""
    return ledger.with_job_ids(_jobs(spark, sf_dir).select("filepath", "platform"))


def ingest_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: gate decision of every request against a ledger holding 3 of 4 jobs."""
    jobs = _jobs(spark, sf_dir)
    stored = jobs.filter(F.col("o_orderkey") % 4 != 0)
    return ledger.gate(jobs.select("filepath", "platform"), stored).select(
        "job_id", "action", "result_status", "error", *ledger.COUNTS)


def _updates(jobs: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    sel = jobs.filter(k % 3 == 0)
    m = k % 9
    status = F.when(m == 0, F.lit("completed")).when(m == 3, F.lit("failed")).otherwise(F.lit("processing"))
    given = m != 3
    return sel.select(
        "job_id", status.alias("status"),
        F.when(given, (k % 500).cast("int")).alias("total_records"),
        F.when(given, (k % 500 - k % 5).cast("int")).alias("valid_records"),
        F.when(given, (k % 5).cast("int")).alias("invalid_records"),
        F.when(given, (k % 40).cast("int")).alias("hotels_upserted"),
        F.when(given, (k % 600).cast("int")).alias("reviews_inserted"),
        F.when(given, (k % 777).cast("int")).alias("processing_time_ms"),
        F.when(m == 3, F.array(F.lit("retry failed"))).alias("errors"),
    )


def ledger_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13: the ledger after status updates for every third job."""
    jobs = _jobs(spark, sf_dir)
    now = F.lit(NOW).cast("timestamp_ntz")
    out = ledger.transition(jobs.select(*ledger.LEDGER_COLUMNS), _updates(jobs), now)
    return out.select("job_id", "status", *ledger.COUNTS, "processing_time_ms", F.array_join("errors", "; ").alias("errors"),
                      "started_at", "completed_at", "updated_at")


def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14: status of every job with its records-per-second figure."""
    jobs = _jobs(spark, sf_dir)
    return jobs.select("job_id", "status", "total_records", "valid_records", "invalid_records",
                       "processing_time_ms",
                       ledger.throughput(F.col("total_records"), F.col("processing_time_ms")).alias("records_per_sec"))


def job_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14b: one job looked up by its id, and whether it is completed."""
    jobs = _jobs(spark, sf_dir)
    wanted = [ledger.job_id(F.lit(LOOKUP_JOB_FILE), F.lit(p)) for p in ledger.PLATFORMS]
    return jobs.filter(F.col("job_id").isin(*wanted)).select(
        "job_id", "filepath", "platform", "status", (F.col("status") == "completed").alias("is_completed"))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q18: jobs and record totals per (platform, status)."""
    return ledger.statistics(_jobs(spark, sf_dir))


def jobs_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q23: newest 10 completed jobs."""
    return reads.newest(_jobs(spark, sf_dir), "status", "completed", "created_at", "job_id", 10) \
        .select("job_id", "filepath", "platform", "status", "created_at")


def jobs_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q24: one page of all jobs, newest first, with the true total."""
    jobs = _jobs(spark, sf_dir)
    lim, off = reads.page_request(PAGE_LIMIT, PAGE_OFFSET)
    rows = reads.page(jobs, "created_at", "desc", "job_id", lim, off).select(
        "job_id", "status", "created_at")
    return reads.envelope(rows, jobs, lim, off)


# -- reads over reviews / hotels -------------------------------------------------

def _review_cols(df: DataFrame) -> DataFrame:
    return df.select("hotel_review_id", "hotel_id", "platform", F.col("rating").cast("double").alias("rating"),
                     "review_date", "processing_job_id")


def _hotel_cols(df: DataFrame) -> DataFrame:
    return df.select("hotel_id", "platform", "hotel_name",
                     F.col("overall_score").cast("double").alias("overall_score"), "review_count")


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q20: hotel by id."""
    return _hotel_cols(reads.lookup(_hotels(spark, sf_dir), "hotel_id", LOOKUP_HOTEL_ID))


def review_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q20b: review by review id."""
    return _review_cols(reads.lookup(_reviews(spark, sf_dir), "hotel_review_id", LOOKUP_REVIEW_ID))


def newest_reviews_by_hotel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q21: the 50 newest reviews of one hotel."""
    return _review_cols(reads.newest(_reviews(spark, sf_dir), "hotel_id", LOOKUP_HOTEL_ID,
                                     "review_date", "hotel_review_id", 50))


def newest_reviews_by_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q21b: the 50 newest reviews of one platform."""
    return _review_cols(reads.newest(_reviews(spark, sf_dir), "platform", "agoda",
                                     "review_date", "hotel_review_id", 50))


def hotels_by_review_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q22: the 50 hotels of one platform with the most reviews (NULLs first)."""
    return _hotel_cols(reads.newest(_hotels(spark, sf_dir), "platform", "agoda",
                                    "review_count", "hotel_id", 50))


def generic_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q25: page 2 of hotels ordered by overall_score DESC, with the pagination envelope."""
    hotels = _hotel_cols(_hotels(spark, sf_dir))
    lim, off = reads.page_request(10, None, 2)
    rows = reads.page(hotels, "overall_score", "desc", "hotel_id", lim, off)
    return reads.envelope(rows, hotels, lim, off)


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q26: row count of each stored table."""
    def n(name, df):
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
    return (n("hotels", _hotels(spark, sf_dir))
            .unionByName(n("reviews", _reviews(spark, sf_dir)))
            .unionByName(n("processing_jobs", _jobs(spark, sf_dir))))


def review_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q27: reviews of one platform within a rating and a date range."""
    r = reads.filter_reviews(_reviews(spark, sf_dir), platform="booking",
                             rating=reads.Range(2, 8),
                             review_date=reads.Range("1994-01-01 00:00:00", "1996-12-31 00:00:00"),
                             has_response=True)
    return _review_cols(r)


def hotel_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q28: hotels of one platform within a score and a review-count range."""
    h = reads.filter_hotels(_hotels(spark, sf_dir), platform="agoda",
                            overall_score=reads.Range(1, 9), review_count=reads.Range(5, 40))
    return _hotel_cols(h)


# -- joins -----------------------------------------------------------------------

def reviews_with_hotel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15: reviews left-joined to their hotel (AQE picks broadcast or sort-merge)."""
    r = _reviews(spark, sf_dir).select("hotel_review_id", "hotel_id", F.col("rating").cast("double").alias("rating"))
    h = _hotels(spark, sf_dir).select("hotel_id", "hotel_name",
                                      F.col("overall_score").cast("double").alias("overall_score"))
    return r.join(h, "hotel_id", "left")


def reviews_with_reviewer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q19b: stored reviews joined to their reviewers (the record's reviewerInfo)."""
    tables = loaded(spark, sf_dir)
    r = tables.reviews().select("hotel_review_id", "hotel_id")
    return r.join(tables.reviewers().select(
        "hotel_review_id", "displayMemberName", "countryName", "countryId", "reviewerReviewedCount", "isExpertReviewer"),
        "hotel_review_id")


def reviews_with_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16: reviews left-joined to the ledger row of the run that stored them."""
    r = _reviews(spark, sf_dir).select("hotel_review_id", "processing_job_id")
    j = run_ledger(spark, sf_dir).select(F.col("job_id").alias("processing_job_id"), "filepath",
                                         "total_records", "reviews_inserted")
    # One row a job against all reviews of it: Spark broadcasts the jobs while they are few, else splits large jobs.
    return r.join(j, "processing_job_id", "left")


def reviewers_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q19: reviewer dimension from customer x nation with per-customer review counts."""
    ensure_conf(spark)
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_nationkey")
    nat = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    cnt = (spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey")
           .agg(F.count(F.lit(1)).alias("n")))
    j = (cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left")
             .join(cnt, cust.c_custkey == cnt.o_custkey, "left"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return j.select(
        F.col("c_custkey").alias("reviewer_id"),
        F.col("c_name").alias("display_member_name"),
        F.col("n_name").alias("country_name"),
        F.col("c_nationkey").alias("country_id"),
        n.cast("int").alias("reviewer_reviewed_count"),
        (n > 10).alias("is_expert_reviewer"),
    )
