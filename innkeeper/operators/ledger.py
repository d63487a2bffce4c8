"""Ingest ledger (processing_jobs) as table data: job ids, gate, transitions, admission.

All operations are joins / column expressions over DataFrames of requests and ledger
rows; one row per file, never per line, so the ledger stays small next to the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Request domains and messages of the service
# ---------------------------------------------------------------------------
PLATFORMS = ["agoda", "booking", "expedia", "hotels", "tripadvisor"]
PROVIDERS = ["local", "s3"]
STATUSES = ["pending", "processing", "completed", "failed"]
MSG_BUSY = "File is currently being processed"
MSG_NOT_VALID = "File is not valid"
MSG_PROVIDER = "Storage provider not supported"
MSG_FIELDS = "Missing required fields: filepath, platform, storageProvider"
MSG_PLATFORM = "Invalid platform"
OBJECT_STORE_EXT = ".jl"

COUNTS = ["total_records", "valid_records", "invalid_records", "hotels_upserted", "reviews_inserted"]
LEDGER_COLUMNS = ["job_id", "filepath", "platform", "storage_provider", "status", *COUNTS,
                  "processing_time_ms", "errors", "metadata",
                  "started_at", "completed_at", "created_at", "updated_at"]


def no_counts() -> list[Column]:
    """NULL (not given) for every counter of an update."""
    return [F.lit(None).cast("int").alias(c) for c in COUNTS]


def job_id(filepath: Column, platform: Column) -> Column:
    """"job-" + md5(filepath + "-" + platform); provider and options are not part of it."""
    return F.concat(F.lit("job-"), F.md5(F.concat_ws("-", filepath, platform)))


def with_job_ids(requests: DataFrame) -> DataFrame:
    return requests.withColumn("job_id", job_id(F.col("filepath"), F.col("platform")))


def gate(requests: DataFrame, ledger: DataFrame, now: Column | None = None) -> DataFrame:
    """Decision per request against the stored job of the same id.

    no job -> create (then run); completed -> already_processed (stored counts);
    processing -> failed "File is currently being processed"; failed/pending -> run again.
    With ``now``, a job in processing whose lease (``lease_until``) is over was left by a
    run that died: it runs again.
    """
    status = F.col("status")
    if now is not None:
        status = F.when((status == "processing") & (F.col("lease_until") < now), F.lit("pending")).otherwise(status)
    led = ledger.select(F.col("job_id").alias("_jid"), status.alias("stored_status"),
                        *[F.col(c).alias("stored_" + c) for c in COUNTS])
    j = with_job_ids(requests).join(led, F.col("job_id") == F.col("_jid"), "left")
    st = F.col("stored_status")
    action = (F.when(F.col("_jid").isNull(), F.lit("create"))
              .when(st == "completed", F.lit("skip"))
              .when(st == "processing", F.lit("reject"))
              .otherwise(F.lit("rerun")))
    result = (F.when(st == "completed", F.lit("already_processed"))
              .when(st == "processing", F.lit("failed"))
              .otherwise(F.lit("completed")))
    return j.select(
        "job_id", "filepath", "platform", action.alias("action"), result.alias("result_status"),
        F.when(st == "processing", F.lit(MSG_BUSY)).alias("error"),
        *[F.when(st == "completed", F.coalesce("stored_" + c, F.lit(0))).otherwise(F.lit(0)).alias(c) for c in COUNTS],
    )


def transition(ledger: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """Apply status updates (one per job_id) the way the ledger update does.

    Always: status, updated_at. processing: started_at. completed/failed: completed_at
    and whichever counters / errors the update gives (NULL = not given).
    Jobs without an update are unchanged.
    """
    u = updates.select(F.col("job_id").alias("_uid"), F.col("status").alias("u_status"),
                       *[F.col(c).alias("u_" + c) for c in
                         [*COUNTS, "processing_time_ms", "errors"]])
    j = ledger.join(u, F.col("job_id") == F.col("_uid"), "left")
    hit = F.col("_uid").isNotNull()
    closing = hit & F.col("u_status").isin("completed", "failed")
    cols = []
    for c in LEDGER_COLUMNS:
        if c == "status":
            e = F.when(hit, F.col("u_status")).otherwise(F.col(c))
        elif c == "updated_at":
            e = F.when(hit, now).otherwise(F.col(c))
        elif c == "started_at":
            e = F.when(hit & (F.col("u_status") == "processing"), now).otherwise(F.col(c))
        elif c == "completed_at":
            e = F.when(closing, now).otherwise(F.col(c))
        elif c in (*COUNTS, "processing_time_ms", "errors"):
            e = F.when(closing, F.coalesce(F.col("u_" + c), F.col(c))).otherwise(F.col(c))
        else:
            e = F.col(c)
        cols.append(e.alias(c))
    return j.select(*cols)


def throughput(total: Column, ms: Column) -> Column:
    """round(totalLines / ms * 1000) records per second; NULL when ms is 0."""
    return F.round(total / F.nullif(ms, F.lit(0)) * 1000).cast("bigint")


def statistics(ledger: DataFrame) -> DataFrame:
    """Jobs and record totals per (platform, status)."""
    return ledger.groupBy("platform", "status").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.sum("total_records").alias("total_records"),
        F.sum("valid_records").alias("valid_records"),
        F.sum("invalid_records").alias("invalid_records"),
        F.sum("hotels_upserted").alias("hotels_upserted"),
        F.sum("reviews_inserted").alias("reviews_inserted"),
        F.sum("processing_time_ms").alias("processing_time_ms"),
    )


def admission(requests: DataFrame, listing: DataFrame) -> DataFrame:
    """Admission per request: metadata present, enum domains, file checks per provider.

    ``listing`` = (path, length) of the files that exist (from a ``binaryFile``
    listing with ``content`` never selected). local: the file must exist;
    s3: it must exist, be non-empty and end with ".jl" (case-sensitive).
    """
    lst = listing.select(F.col("path").alias("_path"), F.col("length").alias("_len"))
    j = requests.join(lst, F.col("filepath") == F.col("_path"), "left")
    exists = F.col("_path").isNotNull()
    blank = lambda c: F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
    err = (F.when(blank("filepath") | blank("platform") | blank("storage_provider"), F.lit(MSG_FIELDS))
           .when(~F.col("platform").isin(*PLATFORMS), F.lit(MSG_PLATFORM))
           .when(~F.col("storage_provider").isin(*PROVIDERS), F.lit(MSG_PROVIDER))
           .when((F.col("storage_provider") == "local") & ~exists, F.lit(MSG_NOT_VALID))
           .when((F.col("storage_provider") == "s3")
                 & ~(exists & (F.coalesce(F.col("_len"), F.lit(0)) > 0)
                     & F.col("filepath").endswith(OBJECT_STORE_EXT)), F.lit(MSG_NOT_VALID)))
    return j.select("filepath", "platform", "storage_provider",
                    err.isNull().alias("admitted"), err.alias("error"))


def is_job_processed(ledger_df: DataFrame, job: str) -> bool:
    """True when the job exists and its status is completed (one-row lookup)."""
    row = ledger_df.filter(F.col("job_id") == F.lit(job)).select("status").limit(1).collect()
    return bool(row) and row[0][0] == "completed"


def list_jobs(ledger_df: DataFrame, status: str | None = None, platform: str | None = None,
              limit=None, offset=None) -> DataFrame:
    """Job listing: filter by status and platform, newest first, one page with its envelope.

    The true total of the filter comes with the rows (nothing runs while the query is
    built); limit 0 / missing / not a number -> 10.
    """
    from .reads import envelope, page, page_request
    cond = F.lit(True)
    if status is not None:
        cond = cond & (F.col("status") == F.lit(status))
    if platform is not None:
        cond = cond & (F.col("platform") == F.lit(platform))
    filtered = ledger_df.filter(cond)
    lim, off = page_request(limit, offset)
    return envelope(page(filtered, "created_at", "desc", "job_id", lim, off), filtered, lim, off)
