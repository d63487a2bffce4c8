"""Store stage: projections into the hotels / reviews tables and keyed merges.

Net semantics reproduced (per file order, ``ord``):
  * hotels: upsert keyed by hotel_id, last row wins for name/score/count/grades,
    platform and created_at stay from the first insert; NULLs overwrite (no coalesce).
  * reviews: insert-ignore keyed by hotel_review_id, the first *storable* row wins.
  * rows violating a column constraint are skipped (they never take part in the
    merge), exactly as the row-wise fallback of a failed bulk statement does.

Everything is a Column expression plus one keyed aggregation per table. Aggregations
are ``min``/``max`` over a struct that starts with ``ord``; Spark plans them as a
partial (map-side) + final aggregate, so a hot key is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsvalue as js
from .records import REC

# ---------------------------------------------------------------------------
# Column limits of the relational schema (varchar lengths)
# ---------------------------------------------------------------------------
REVIEW_TEXT_LIMITS = {
    "platform": 50,
    "rating_text": 100,
    "review_title": 500,
    "review_comments": None,
    "review_positives": None,
    "review_negatives": None,
    "check_in_date_month_and_year": 50,
    "responder_name": 255,
    "response_date_text": 100,
    "translate_source": 10,
    "translate_target": 10,
    "encrypted_review_data": 255,
    "review_provider_text": 100,
    "processing_job_id": 255,
}
HOTEL_TEXT_LIMITS = {"platform": 50, "hotel_name": 500}
# record field -> review column (text columns)
REVIEW_TEXT_FIELDS = {
    "ratingText": "rating_text",
    "reviewTitle": "review_title",
    "reviewComments": "review_comments",
    "reviewPositives": "review_positives",
    "reviewNegatives": "review_negatives",
    "checkInDateMonthAndYear": "check_in_date_month_and_year",
    "responderName": "responder_name",
    "responseDateText": "response_date_text",
    "translateSource": "translate_source",
    "translateTarget": "translate_target",
    "encryptedReviewData": "encrypted_review_data",
    "reviewProviderText": "review_provider_text",
}

REVIEW_COLUMNS = [
    "hotel_review_id", "hotel_id", "reviewer_id", "platform", "rating", "rating_text",
    "review_title", "review_comments", "review_positives", "review_negatives", "review_date",
    "check_in_date_month_and_year", "is_show_review_response", "responder_name",
    "response_date_text", "translate_source", "translate_target", "encrypted_review_data",
    "provider_id", "review_provider_text", "processing_job_id",
]
BETWEEN = "\u0001"   # no error's text holds it
# What the projections read of a record (check_lines' columns).
HOTEL_INPUTS = ["rec_truthy", "b_platform", "b_hotelId", "b_hotelReviewId", "b_hotelName", "r_rating", "t_hotelId", "s_hotelId",
                "n_hotelId", "r_platform", "s_platform", "r_hotelName", "s_hotelName", "r_overallByProviders"]
REVIEW_INPUTS = ["rec_truthy", "b_platform", "b_hotelId", "b_hotelReviewId", "b_rating", "r_rating", "t_hotelReviewId", "s_hotelReviewId",
                 "n_hotelReviewId", "t_hotelId", "s_hotelId", "n_hotelId", "r_platform", "s_platform", "t_rating", "s_rating", "n_rating",
                 "r_providerId", "t_providerId", "s_providerId", "n_providerId", "b_isShowReviewResponse", "r_reviewDate", "t_reviewDate",
                 "b_reviewDate", *[f"str_{f}" for f in REVIEW_TEXT_FIELDS]]
HOTEL_COLUMNS = ["hotel_id", "platform", "hotel_name", "overall_score", "review_count", "grades"]


def _text_errors(limits: dict[str, int | None]) -> list[Column]:
    out = []
    for name, n in limits.items():
        c = F.col(name)
        out.append(F.when(F.contains(c, F.lit("\u0000")), F.lit(f"{name}: contains NUL")))
        if n is not None:   # characters are counted where the bytes, which Spark knows, are too many
            out.append(F.when((F.octet_length(c) > n) & (F.length(c) > n), F.lit(f"{name}: longer than {n}")))
    return out


def store_eligible() -> Column:
    """record && platform && hotelId && hotelReviewId && rating !== undefined."""
    return (F.col("rec_truthy") & REC.truthy("platform") & REC.truthy("hotelId")
            & REC.truthy("hotelReviewId") & js.present(REC["rating"]))


def _int_of(name: str) -> Column:
    return js.pg_int32(REC[name], REC.t(name), REC.text(name), REC.num(name))


@js.per_context
def _review_exprs() -> tuple[list[tuple], list[Column]]:
    """The review's columns but its date, in pieces (a method of more than 8,000 bytes would stay interpreted by the JVM), and the errors."""
    rating, t_rating = REC["rating"], REC.t("rating")
    rating_d = (F.when(js.is_string(rating, t_rating), js.js_parse_float(REC.text("rating")))
                .when(js.is_number(rating, t_rating), REC.num("rating")))
    # The provider's number is a projection (js.project): its lambda ends the compiled stage, where its method would be too long.
    pieces = [
        (js.project, {"_provider_num": js.js_number(REC["providerId"], REC.t("providerId"), REC.text("providerId"), REC.num("providerId"))}),
        (js.fence, {"hotel_review_id": _int_of("hotelReviewId"), "hotel_id": _int_of("hotelId")}),
        (js.fence, {"reviewer_id": F.lit(None).cast("int"), "platform": js.pg_text(REC["platform"], REC.text("platform")),
                    "rating": js.to_decimal31(rating_d)}),
        (js.fence, {"_provider_given": ~js.is_null_or_undefined(REC["providerId"]),
                    "provider_id": F.when(~js.is_null_or_undefined(REC["providerId"]), js.double_to_int32(F.col("_provider_num")))}),
    ]
    errs = [
        F.when(F.col("hotel_review_id").isNull(), F.lit("hotel_review_id: not an integer")),
        F.when(F.col("hotel_id").isNull(), F.lit("hotel_id: not an integer")),
        F.when(F.col("platform").isNull(), F.lit("platform: null")),
        F.when(F.col("rating").isNull(), F.lit("rating: not numeric(3,1)")),
        F.when(F.col("review_date").isNull(), F.lit("review_date: invalid date")),
        F.when(F.col("_provider_given") & F.col("provider_id").isNull(), F.lit("provider_id: not an integer")),
    ] + _text_errors(REVIEW_TEXT_LIMITS)
    return pieces, errs


def _flagged(df: DataFrame, **more: Column) -> DataFrame:
    """``_eligible`` and what builds on it."""
    return js.fence(df if "_eligible" in df.columns else js.fence(df, _eligible=store_eligible()), **more)


def review_rows(valid: DataFrame, job_id: Column, keep_all: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Review projection of store-eligible records with truthy id and rating.

    Keeps ``file``/``ord`` and adds ``storage_errors`` (empty = storable). With
    ``keep_all`` every input row is kept with flags ``_eligible`` / ``_review_row``
    (and the other input columns, or those that ``keep`` names), for single-pass counters.
    """
    pieces, errs = _review_exprs()
    df = _flagged(valid, _review_row=F.col("_eligible") & REC.truthy("hotelReviewId") & REC.truthy("rating"))
    if keep_all:
        kept = [*(valid.columns if keep is None else keep), "_eligible", "_review_row"]
    else:
        df, kept = df.filter(F.col("_review_row")), ["file", "ord"]
    kept = list(dict.fromkeys(kept))
    # The job of a line may be told by any of its columns.
    df = df.withColumn("processing_job_id", job_id)
    inputs = [c for c in REVIEW_INPUTS if c in df.columns]
    df = df.select(F.array(F.struct(*kept)).alias("_kept"), "processing_job_id", *inputs)
    for add, columns in pieces:
        df = add(df, **columns)
    names = [c for c in REVIEW_COLUMNS if c not in ("review_date", "processing_job_id")]
    made = {colname: REC.string(fld) for fld, colname in REVIEW_TEXT_FIELDS.items()} | {"is_show_review_response": REC.truthy("isShowReviewResponse")}
    df = df.select("_kept", "processing_job_id", "_provider_given", "r_reviewDate", "t_reviewDate", "b_reviewDate",
                   *[made[c].alias(c) if c in made else c for c in names])
    df = js.with_js_date(df, "review_date", REC["reviewDate"], REC.t("reviewDate"), REC.truthy("reviewDate"))
    df = js.compact_fence(df.select("_kept", *REVIEW_COLUMNS, "_provider_given"), "storage_errors", errs, BETWEEN)
    made = [c for c in (*REVIEW_COLUMNS, "storage_errors") if c not in kept]
    return df.select(F.inline("_kept"), *made)


def hotel_rows(valid: DataFrame, keep_all: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Hotel projection of store-eligible records with truthy hotelId and hotelName.

    With ``keep_all`` every input row is kept (its columns, or those that ``keep`` names), flagged ``_eligible`` /
    ``_hotel_row``, with the hotel columns prefixed ``h_`` and their errors in ``hotel_errors``.
    """
    df = _flagged(valid, _hotel_row=F.col("_eligible") & REC.truthy("hotelId") & REC.truthy("hotelName"))
    if keep_all:
        kept = [*(valid.columns if keep is None else keep), "_eligible", "_hotel_row"]
    else:
        df, kept = df.filter(F.col("_hotel_row")), ["file", "ord"]
    df = df.select(F.array(F.struct(*kept)).alias("_kept"), "t_hotelId", "s_hotelId", "n_hotelId", "r_platform", "s_platform",
                   "r_hotelName", "s_hotelName", "r_overallByProviders")
    pre = "h_" if keep_all else ""
    df = js.fence(df, **{pre + "hotel_id": _int_of("hotelId"),
                         pre + "platform": js.pg_text(REC["platform"], REC.text("platform")),
                         pre + "hotel_name": js.pg_text(REC["hotelName"], REC.text("hotelName"))})
    named = ["_kept", *[pre + c for c in HOTEL_COLUMNS[:3]]]
    df = js.fence(df.select(*named, "r_overallByProviders"), _p0=F.try_variant_get(
        REC["overallByProviders"], "$[0]", "struct<overallScore: variant, reviewCount: variant, grades: variant>"))
    df = df.select(*named, F.col("_p0.overallScore").alias("_score"),
                   F.col("_p0.reviewCount").alias("_count"), F.col("_p0.grades").alias("_grades"))
    df = js.fence(df, _t_score=js.vtype(F.col("_score")), _t_count=js.vtype(F.col("_count")),
                  _t_grades=js.vtype(F.col("_grades")))
    score, ts = F.col("_score"), F.col("_t_score")
    score_given = ~js.is_null_or_undefined(score)
    count = F.col("_count")
    df = js.fence(df, _n_score=js.as_double(score, ts), _s_score=js.as_string(score, ts),
                  _n_count=js.as_double(count, F.col("_t_count")), _s_count=js.as_string(count, F.col("_t_count")))
    df = js.project(df, _count_num=js.js_number(count, F.col("_t_count"), F.col("_s_count"), F.col("_n_count")),
                    _score_dec=F.when(js.is_number(score, ts), js.to_decimal31(F.col("_n_score")))
                    .when(js.is_string(score, ts), js.pg_numeric_text(F.col("_s_score"))))
    score_dec = F.col("_score_dec")
    review_count = F.when(count.isNull(), F.lit(0)).otherwise(js.double_to_int32(F.col("_count_num")))
    grades = F.col("_grades")
    df = js.fence(
        df,
        **{pre + "overall_score": F.when(score_given, score_dec),
           pre + "review_count": review_count,
           pre + "grades": F.when(js.truthy(grades, F.col("_t_grades")), F.to_json(grades)).otherwise(F.lit("{}")),
           "_bad_score": score_given & score_dec.isNull()},
    )
    errs = [
        F.when(F.col(pre + "hotel_id").isNull(), F.lit("hotel_id: not an integer")),
        F.when(F.col(pre + "platform").isNull(), F.lit("platform: null")),
        F.when(F.col("_bad_score"), F.lit("overall_score: not numeric(3,1)")),
        F.when(F.col(pre + "review_count").isNull(), F.lit("review_count: not an integer")),
    ] + _text_errors({pre + k: v for k, v in HOTEL_TEXT_LIMITS.items()})
    found = "hotel_errors" if keep_all else "storage_errors"
    made = [pre + c for c in HOTEL_COLUMNS]
    df = js.compact_fence(df.select("_kept", *made, "_bad_score"), found, errs, BETWEEN)
    return df.select(F.inline("_kept"), *made, found)


def _storable(df: DataFrame) -> DataFrame:
    return df.filter(F.size("storage_errors") == 0)


def first_reviews(rows: DataFrame) -> DataFrame:
    """Insert-ignore of one load: per hotel_review_id the first storable row (by ord).

    The winners are found on (key, ord) alone, combined before the shuffle, and their
    other columns fetched by these two: no text is sorted or carried through an
    aggregation. ``rows`` is read twice, so pass stored rows (session.staged).
    """
    ok = _storable(rows)
    first = ok.groupBy("hotel_review_id").agg(F.min("ord").alias("_ord")).withColumnRenamed("hotel_review_id", "_key")
    return ok.join(first, (F.col("hotel_review_id") == F.col("_key")) & (F.col("ord") == F.col("_ord")), "left_semi").select(
        *REVIEW_COLUMNS, "ord")


def fold_hotels(rows: DataFrame) -> DataFrame:
    """Upsert of one load folded per hotel_id (last row wins; first platform kept).

    ``upserts`` = number of storable rows = accepted upsert statements.
    """
    agg = (_storable(rows)
           .groupBy("hotel_id")
           .agg(F.max(F.struct("ord", "hotel_name", "overall_score", "review_count", "grades")).alias("_last"),
                F.min(F.struct("ord", "platform")).alias("_first"),
                F.count(F.lit(1)).alias("upserts")))
    return agg.select(
        "hotel_id",
        F.col("_first")["platform"].alias("platform"),
        F.col("_last")["hotel_name"].alias("hotel_name"),
        F.col("_last")["overall_score"].alias("overall_score"),
        F.col("_last")["review_count"].alias("review_count"),
        F.col("_last")["grades"].alias("grades"),
        "upserts",
    )


def merge_hotels(existing: DataFrame, folded: DataFrame, run_ts: Column) -> DataFrame:
    """ON CONFLICT(hotel_id) DO UPDATE of a folded load into the existing table.

    platform and created_at keep the stored values; the other four columns take the
    new row's values when the key is matched, NULLs included.
    """
    e = existing.select(*[F.col(c).alias("e_" + c) for c in existing.columns])
    n = folded.select(*[F.col(c).alias("n_" + c) for c in HOTEL_COLUMNS])
    j = e.join(n, F.col("e_hotel_id") == F.col("n_hotel_id"), "full_outer")
    hit = F.col("n_hotel_id").isNotNull()
    cols = [F.coalesce("e_hotel_id", "n_hotel_id").alias("hotel_id"),
            F.when(F.col("e_hotel_id").isNotNull(), F.col("e_platform")).otherwise(F.col("n_platform")).alias("platform")]
    for c in ["hotel_name", "overall_score", "review_count", "grades"]:
        cols.append(F.when(hit, F.col("n_" + c)).otherwise(F.col("e_" + c)).alias(c))
    cols += [F.when(F.col("e_hotel_id").isNotNull(), F.col("e_created_at")).otherwise(run_ts).alias("created_at"),
             F.when(hit, run_ts).otherwise(F.col("e_updated_at")).alias("updated_at")]
    return j.select(*cols)


def merge_reviews(existing: DataFrame, first: DataFrame, run_ts: Column) -> DataFrame:
    """ON CONFLICT DO NOTHING: existing rows stay, only unseen keys are appended."""
    new = (first.join(existing.select("hotel_review_id"), "hotel_review_id", "left_anti")
           .select(*REVIEW_COLUMNS, run_ts.alias("created_at"), run_ts.alias("updated_at")))
    return existing.select(*REVIEW_COLUMNS, "created_at", "updated_at").unionByName(new)


def new_reviews(existing_keys: DataFrame, first: DataFrame) -> DataFrame:
    """Rows of ``first`` whose key is not stored yet (the rows an append writes)."""
    return first.join(existing_keys.select("hotel_review_id"), "hotel_review_id", "left_anti")


def key_ranges(rows: DataFrame, key: str, most: int) -> list[tuple[int, int]]:
    """At most ``most`` ranges [low, high] that hold every key of ``rows`` and few others: the least and largest
    key of each of ``most`` equally wide parts of the whole range. Two aggregates of one column."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None:
        return []
    width = (high - low) // most + 1
    parts = rows.groupBy(F.floor((F.col(key).cast("bigint") - low) / width).alias("part")).agg(
        F.min(key).alias("low"), F.max(key).alias("high")).collect()
    out = []
    for p in sorted(parts, key=lambda p: p["part"]):
        if out and p["low"] <= out[-1][1] + 1:
            out[-1] = (out[-1][0], p["high"])
        else:
            out.append((p["low"], p["high"]))
    return out


def within(ranges: list[tuple[int, int]], key: str) -> Column:
    """The key lies in one of the ranges: pushed to the scan, where row groups and pages beside them are skipped."""
    cond = F.lit(False)
    for low, high in ranges:
        cond = cond | F.col(key).between(low, high)
    return cond
