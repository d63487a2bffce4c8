"""Line sources derived from the provided star-schema tables.

The review feed is built from lineitem x supplier x part by pure expressions, so the
DuckDB oracle can recompute every expected value from the same tables. The lines
then go through the very same parse/validate/store operators as text files do.
All sizes grow with the tables: one review line per lineitem row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import job_id
from . import text

# ---------------------------------------------------------------------------
# Fixed values of the review bridge (the oracle SQL repeats them)
# ---------------------------------------------------------------------------
N_FILES = 4                       # file = 'f' || (l_orderkey % 4)
ZERO_REVIEW_ID_MOD = 89           # hotelReviewId = 0 (falsy) when l_orderkey % 89 = 0
PLATFORMS = ["agoda", "booking", "expedia", "  ", "tripadvisor"]  # by l_linenumber % 5
NULL_RATING_MOD = 83              # "rating": null
ABSENT_RATING_MOD = 79            # no rating key
NULL_NAME_MOD = 10                # hotelName null when s_suppkey % 10 = 9
ABSENT_DATE_MOD = 73              # no reviewDate key
BAD_DATE_MOD = 71                 # reviewDate "not a date"
CLOCK_ONLY_MOD = 113              # reviewDate "12:30", which is no date either
STRING_ID_MOD = 9                 # hotelReviewId as text
STRING_RATING_MOD = 67            # rating as text with letters after the number
STRING_HOTEL_MOD = 12             # hotelId as text when l_orderkey % 12 = 5
LONG_TARGET_MOD = 103             # translateTarget of 11 letters
BAD_PROVIDER_MOD = 61             # providerId "abc" (where l_orderkey % 8 = 6)
FALSY_MOD = 59                    # a line null, 0, "" or false (by l_orderkey % 4) after the record
LONG_TITLE_MOD = 101              # reviewTitle of 501 'x' when l_partkey % 101 = 0
NO_PROVIDER_MOD = 7               # overallByProviders [] when s_suppkey % 7 = 0
NESTED_MOD = 2                    # nested under "comment" when l_orderkey % 2 = 0
MALFORMED_MOD = 97                # last character dropped
BLANK_MOD = 53                    # one blank line after the record (no-break space and BOM for odd keys)
REQUEST_PLATFORM = "agoda"        # platform of the ingest request for every bridge file
SPLIT_DATE = "1998-06-01"         # two-load split for the merge queries (by l_shipdate)

# Ledger bridge (orders -> processing_jobs)
JOB_PLATFORMS = {"1": "agoda", "2": "booking", "3": "expedia", "4": "hotels", "5": "tripadvisor"}
JOB_STATUS = {"F": "completed", "P": "processing", "O": "failed"}
PENDING_MOD = 10


_TABLES: dict = {}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The provided (read-only) table; the scan DataFrame is reused within a session,
    so its file listing and footer schema are read once, not once per query."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[key]


TASKS_A_CORE = 4
ROWS_A_TASK = 200_000    # of a large table: the last tasks end soon after the others
LINES_A_PART = 50_000    # of a written feed


def spread(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """Deal the rows over the cluster: by a hash of the ``keys``, which together tell rows apart, else
    round-robin, for which Spark sorts all rows first.

    Per-row work downstream (JSON build, parse, rules) is CPU heavy, and a file with a
    single row group is read by one task. Several tasks a core, so that what each of
    them sorts or holds stays small; more where there are that many ``rows``.
    """
    return df.repartition(max(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism, rows // ROWS_A_TASK), *keys)


_COUNTS: dict = {}


def _rows(spark: SparkSession, sf_dir: str) -> int:
    """lineitem's rows, by its footers."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _COUNTS:
        _COUNTS[key] = _t(spark, sf_dir, "lineitem").count()
    return _COUNTS[key]


def _json_string(c: Column) -> Column:
    """JSON string literal of a text column (quotes and escapes via to_json)."""
    j = F.to_json(F.array(c))
    return F.substring(j, F.lit(2), F.length(j) - 2)


def review_source(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """One row per lineitem row with the JSON fragments a review line is built from, ``dealt`` over the cluster.

    Fragments that depend only on the supplier (hotel name, provider score) or the
    part (title) are encoded once per dimension row, before the join.
    """
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    su = _t(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % NULL_NAME_MOD == 9, F.lit("null"))
         .otherwise(_json_string(F.col("s_name"))).alias("name_json"),
        F.when(F.col("s_suppkey") % NO_PROVIDER_MOD == 0, F.lit(None).cast("string"))
         .otherwise((F.col("s_acctbal") / 1000).cast("string")).alias("score_json"))
    pa = _t(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % LONG_TITLE_MOD == 0, _json_string(F.repeat(F.lit("x"), 501)))
         .otherwise(_json_string(F.col("p_name"))).alias("title_json"))
    # Dimension joins: Catalyst broadcasts supplier/part only while their
    # estimated size is under spark.sql.autoBroadcastJoinThreshold; otherwise
    # it plans a shuffle join. No unconditional broadcast hint.
    # Dealt after the joins: a shuffle join leaves about as many tasks as cores, however much they hold.
    rows = (li.join(su, li.l_suppkey == su.s_suppkey, "inner")
              .join(pa, li.l_partkey == pa.p_partkey, "inner"))
    return spread(rows, *li.columns, rows=_rows(spark, sf_dir)) if dealt else rows


def _platform(linenumber: Column) -> Column:
    m = linenumber % len(PLATFORMS)
    expr = F.lit(PLATFORMS[-1])
    for i in range(len(PLATFORMS) - 2, -1, -1):
        expr = F.when(m == i, F.lit(PLATFORMS[i])).otherwise(expr)
    return expr


def _by(key: Column, *choices: Column) -> Column:
    """choices[key % len(choices)], as text."""
    out = choices[-1]
    for k in range(len(choices) - 2, -1, -1):
        out = F.when(key % len(choices) == k, choices[k]).otherwise(out)
    return out


def _other_fields() -> Column:
    """The review's remaining fields as JSON members, each led by a comma; what is left out is undefined."""
    ok, s = F.col("l_orderkey"), lambda c: F.col(c).cast("string")
    text = lambda name, *parts: F.concat(F.lit(f',"{name}":"'), *parts, F.lit('"'))
    raw = lambda name, *parts: F.concat(F.lit(f',"{name}":'), *parts)
    provider = _by(ok, raw("providerId", (F.col("l_partkey") % 1000).cast("string")), text("providerId", F.lit(" 12 ")),
                   raw("providerId", F.lit("null")), raw("providerId", F.lit("[5]")), F.lit(""), text("providerId", F.lit("")),
                   F.when(ok % BAD_PROVIDER_MOD == 0, text("providerId", F.lit("abc"))).otherwise(raw("providerId", F.lit("77"))),
                   raw("providerId", F.lit("true")))
    shown = _by(ok, raw("isShowReviewResponse", F.lit("true")), text("isShowReviewResponse", F.lit("false")),
                raw("isShowReviewResponse", F.lit("false")), raw("isShowReviewResponse", F.lit("0")), F.lit(""))
    country = (F.col("l_suppkey") % 5).cast("string")
    reviewer = (F.when(ok % 10 < 3, raw("reviewerInfo", F.lit('{"countryName":"C'), country, F.lit('","displayMemberName":"M'),
                                        s("l_partkey"), F.lit('","countryId":'), country, F.lit(',"reviewerReviewedCount":'),
                                        s("l_linenumber"), F.lit(',"isExpertReviewer":'), (F.col("l_linenumber") > 3).cast("string"), F.lit("}")))
                .when(ok % 10 == 3, raw("reviewerInfo", F.lit("null"))).otherwise(F.lit("")))
    return F.concat(
        text("ratingText", F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")),
        F.when(ok % 5 == 0, raw("reviewComments", F.lit("null"))).otherwise(text("reviewComments", F.lit("c"), s("l_partkey"))),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit("")).otherwise(text("reviewPositives", F.lit("p"), s("l_suppkey"))),
        F.when(ok % 4 == 1, raw("reviewNegatives", s("l_suppkey"))).otherwise(text("reviewNegatives", F.lit("n"), s("l_linenumber"))),
        text("checkInDateMonthAndYear", F.date_format("l_shipdate", "yyyy-MM")),
        F.when(ok % 11 == 0, raw("responderName", F.lit("true"))).otherwise(text("responderName", F.lit("r"), s("l_suppkey"))),
        text("responseDateText", F.lit("d"), s("l_linenumber")), text("translateSource", F.lit("en")),
        text("translateTarget", F.when(ok % LONG_TARGET_MOD == 0, F.lit("x" * 11)).otherwise(F.lit("de"))),
        text("encryptedReviewData", F.lit("e"), s("l_orderkey")), text("reviewProviderText", F.lit("P"), (F.col("l_partkey") % 5).cast("string")),
        provider, shown, reviewer)


def _line() -> Column:
    """A review line of a source row: nested under "comment" for even order keys, flat otherwise; put together from JSON
    fragments by string concatenation (no per-row JSON encoder)."""
    ok = F.col("l_orderkey")
    s = lambda c: c.cast("string")
    rid = (F.when(ok % ZERO_REVIEW_ID_MOD == 0, F.lit("0"))
           .when(ok % STRING_ID_MOD == 0, F.concat(F.lit('"'), s(ok * 8 + F.col("l_linenumber")), F.lit('"')))
           .otherwise(s(ok * 8 + F.col("l_linenumber"))))
    number = s((F.col("l_quantity") - 3) / 4.0)
    hotel = F.when(ok % STRING_HOTEL_MOD == 5, F.concat(F.lit('"'), s(F.col("l_suppkey")), F.lit('"'))).otherwise(s(F.col("l_suppkey")))
    rating = (F.when(ok % ABSENT_RATING_MOD == 0, F.lit(""))
              .when(ok % NULL_RATING_MOD == 0, F.lit(',"rating":null'))
              .when(ok % STRING_RATING_MOD == 0, F.concat(F.lit(',"rating":"'), number, F.lit('abc"')))
              .otherwise(F.concat(F.lit(',"rating":'), number)))
    date = _by(ok, *[F.date_format(F.col("l_shipdate"), form) for form in (
        "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "M/d/yyyy", "MMM d, yyyy", "d MMMM yyyy", "EEE, dd MMM yyyy HH:mm:ss 'GMT'", "yyyy-MM-dd")])
    rdate = (F.when(ok % ABSENT_DATE_MOD == 0, F.lit(""))
             .when(ok % BAD_DATE_MOD == 0, F.lit(',"reviewDate":"not a date"'))
             .when(ok % CLOCK_ONLY_MOD == 0, F.lit(',"reviewDate":"12:30"'))
             .otherwise(F.concat(F.lit(',"reviewDate":"'), date, F.lit('"'))))
    providers = F.when(F.col("score_json").isNull(), F.lit("[]")).otherwise(F.concat(
        F.lit('[{"overallScore":'), F.col("score_json"),
        F.lit(',"reviewCount":'), s(F.col("l_partkey") % 50),
        F.lit(',"grades":{"clean":'), s(F.col("l_partkey") % 10), F.lit("}}]")))
    head = F.concat(F.lit('{"hotelId":'), hotel,
                    F.lit(',"platform":"'), _platform(F.col("l_linenumber")),
                    F.lit('","hotelName":'), F.col("name_json"))
    review = F.concat(F.lit('"hotelReviewId":'), rid, rating,
                      F.lit(',"reviewTitle":'), F.col("title_json"), rdate, _other_fields())
    tail = F.concat(F.lit(',"overallByProviders":'), providers, F.lit("}"))
    nested = F.concat(head, F.lit(',"comment":{'), review, F.lit("}"), tail)
    flat = F.concat(head, F.lit(","), review, tail)
    return F.when(ok % NESTED_MOD == 0, nested).otherwise(flat)


def _subs() -> Column:
    """A blank line (sub = 1) and a falsy one (sub = 2) follow some records."""
    ok = F.col("l_orderkey")
    return F.array_compact(F.array(F.lit(0), F.when(ok % BLANK_MOD == 0, F.lit(1)), F.when(ok % FALSY_MOD == 0, F.lit(2))))


def _file() -> Column:
    return F.concat(F.lit("f"), (F.col("l_orderkey") % N_FILES).cast("string"))


def _value(line: Column) -> Column:
    """The text of a line: the record's (its last character dropped from some), a blank or a falsy one."""
    ok = F.col("l_orderkey")
    record = F.when(ok % MALFORMED_MOD == 0, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    blank = F.when(ok % 2 == 1, F.lit("\u00a0\ufeff")).otherwise(F.lit(""))
    falsy = _by(ok, *[F.lit(x) for x in ("null", "0", '""', "false")])
    return F.when(F.col("_sub") == 0, record).when(F.col("_sub") == 1, blank).otherwise(falsy)


def _ord_fields() -> list[Column]:
    return [(F.col("l_orderkey") % N_FILES).alias("file_rank"), F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber"),
            F.col("l_partkey"), F.col("l_suppkey"), F.col("_sub")]


def review_lines(spark: SparkSession, sf_dir: str, with_load: bool = False) -> DataFrame:
    """(file, ord, value) review lines; ``load`` (1/2) added when ``with_load``."""
    # The lambda in array_compact keeps the long expression of the line out of one generated method, which the JVM would
    # interpret for its length.
    df = review_source(spark, sf_dir).select("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                             _line().alias("_line"), _subs().alias("_subs"))
    df = df.withColumn("_sub", F.explode("_subs"))
    load = F.when(F.col("l_shipdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz"), F.lit(1)).otherwise(F.lit(2))
    ord_fields = _ord_fields()
    if with_load:
        ord_fields = [load.alias("load")] + ord_fields
    out = [_file().alias("file"), F.struct(*ord_fields).alias("ord"), _value(F.col("_line")).alias("value")]
    if with_load:
        out.append(load.alias("load"))
    return df.select(*out)


def write_review_feed(spark: SparkSession, sf_dir: str, root: str, parts: int | None = None, compression: str | None = None,
                      files: list[str] | None = None, suffix: str = "", change=None) -> None:
    """``text.write_feed`` of the review lines, in their order: what is shuffled and sorted are the rows that the lines are
    made from, a fifth of their size, and the lines are made when they are written.

    ``files``: these alone. ``suffix``: of the files' names. ``change(value)``: what becomes of a line's text. Without
    ``parts`` their number follows the number of rows.
    """
    rows = review_source(spark, sf_dir, dealt=False).withColumn("_sub", F.explode(_subs())).withColumn("file", F.concat(_file(), F.lit(suffix)))
    share = 1.0
    if files is not None:
        rows, share = rows.where(_file().isin(*files)), len(files) / N_FILES
    rows = rows.withColumn("ord", F.struct(*_ord_fields()))

    def lines(ranged: DataFrame) -> DataFrame:
        # As in review_lines: the lambda keeps the line's expression out of a compiled stage.
        made = ranged.select("file", "ord", "l_orderkey", F.get(F.array_compact(F.array("_sub")), F.lit(0)).alias("_sub"), _line().alias("_line"))
        value = _value(F.col("_line"))
        return made.select("file", (value if change is None else change(value)).alias("value"))

    text.write_feed(rows, root, parts or max(1, round(share * _rows(spark, sf_dir) / LINES_A_PART)), compression, lines)


def request_job_id(file: Column, platform: Column | None = None) -> Column:
    """Job id of a bridge file, requested for ``REQUEST_PLATFORM`` unless said otherwise."""
    return job_id(file, F.lit(REQUEST_PLATFORM) if platform is None else platform)


def jobs_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """processing_jobs ledger rows derived from orders (one job per order)."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                            "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    prio = F.substring("o_orderpriority", 1, 1)
    platform = F.lit(None).cast("string")
    for code, name in JOB_PLATFORMS.items():
        platform = F.when(prio == code, F.lit(name)).otherwise(platform)
    status = F.lit("pending")
    for code, name in JOB_STATUS.items():
        status = F.when(F.col("o_orderstatus") == code, F.lit(name)).otherwise(status)
    status = F.when(k % PENDING_MOD == 0, F.lit("pending")).otherwise(status)
    filepath = F.concat(F.lit("orders/"), k.cast("string"), F.lit(".jl"))
    total = (k % 1000).cast("int")
    invalid = ((k % 1000) % 7).cast("int")
    done = status.isin("completed", "failed")
    return o.select(
        request_job_id(filepath, platform).alias("job_id"),
        filepath.alias("filepath"),
        platform.alias("platform"),
        F.when(k % 3 == 0, F.lit("s3")).otherwise(F.lit("local")).alias("storage_provider"),
        status.alias("status"),
        F.when(done, total).otherwise(F.lit(0)).alias("total_records"),
        F.when(done, total - invalid).otherwise(F.lit(0)).alias("valid_records"),
        F.when(done, invalid).otherwise(F.lit(0)).alias("invalid_records"),
        F.when(done, (k % 50).cast("int")).otherwise(F.lit(0)).alias("hotels_upserted"),
        F.when(done, (k % 700).cast("int")).otherwise(F.lit(0)).alias("reviews_inserted"),
        F.when(done, (F.floor("o_totalprice") % 5000).cast("int")).otherwise(F.lit(0)).alias("processing_time_ms"),
        F.when(status == "failed", F.array(F.concat(F.lit("File processing failed: order "), k.cast("string"))))
         .otherwise(F.array().cast("array<string>")).alias("errors"),
        F.lit(None).cast("string").alias("metadata"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.when(status != "pending", F.col("o_orderdate")).alias("started_at"),
        F.when(done, F.col("o_orderdate")).alias("completed_at"),
        k.alias("o_orderkey"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, ord, value, event_id): events.props as JSON lines, truncated when event_id % 13 = 0."""
    e = _t(spark, sf_dir, "events").select("event_id", "props", "event_type")
    val = F.when(F.col("event_id") % 13 == 0, F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    return e.select(F.col("event_type").alias("file"),
                    F.struct(F.col("event_id")).alias("ord"), val.alias("value"), "event_id")


# Admission bridge (orders -> ingest requests + an object listing)
BAD_EXT_MOD = 17        # filepath ends with ".json" instead of ".jl"
BAD_PLATFORM_MOD = 19   # request platform outside the enum
MISSING_FILE_MOD = 11   # no such file in the listing
SIZE_MOD = 13           # listed size = (o_orderkey % 13) * 100 bytes (0 = empty object)
BLANK_PROVIDER_MOD = 23  # no provider given
OTHER_PROVIDER_MOD = 29  # a provider that nobody knows
BLANK_PLATFORM_MOD = 31  # a platform of spaces


def admission_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingest request per order: (filepath, platform, storage_provider)."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    k = F.col("o_orderkey")
    prio = F.substring("o_orderpriority", 1, 1)
    platform = F.lit(None).cast("string")
    for code, name in JOB_PLATFORMS.items():
        platform = F.when(prio == code, F.lit(name)).otherwise(platform)
    platform = F.when(k % BAD_PLATFORM_MOD == 0, F.lit("unknown")).when(k % BLANK_PLATFORM_MOD == 0, F.lit("  ")).otherwise(platform)
    provider = (F.when(k % BLANK_PROVIDER_MOD == 0, F.lit("")).when(k % OTHER_PROVIDER_MOD == 0, F.lit("gcs"))
                .when(k % 3 == 0, F.lit("s3")).otherwise(F.lit("local")))
    ext = F.when(k % BAD_EXT_MOD == 0, F.lit(".json")).otherwise(F.lit(".jl"))
    return o.select(
        F.concat(F.lit("orders/"), k.cast("string"), ext).alias("filepath"),
        platform.alias("platform"),
        provider.alias("storage_provider"),
    )


def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, length) of the files that exist, in the shape of a binaryFile listing."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    ext = F.when(k % BAD_EXT_MOD == 0, F.lit(".json")).otherwise(F.lit(".jl"))
    return (o.filter(k % MISSING_FILE_MOD != 0)
             .select(F.concat(F.lit("orders/"), k.cast("string"), ext).alias("path"),
                     ((k % SIZE_MOD) * 100).alias("length")))
