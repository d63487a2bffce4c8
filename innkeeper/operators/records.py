"""Line -> record: blank drop, strict parse, flatten, rule validation.

Input contract (every line source delivers it): a DataFrame with
  ``file STRING``  logical file the line came from,
  ``ord  STRUCT``  a total order of lines in the run (file order, then position),
  ``value STRING`` the physical line.
Output keeps one row per input line (blank ones included, so totals stay exact).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsvalue as js

# ---------------------------------------------------------------------------
# Record layout of the review feed and the service's messages
# ---------------------------------------------------------------------------
TOP_FIELDS = ["hotelId", "platform", "hotelName"]
COMMENT_FIELDS = [
    "hotelReviewId", "providerId", "rating", "ratingText", "reviewTitle",
    "reviewComments", "reviewDate", "checkInDateMonthAndYear", "isShowReviewResponse",
    "responderName", "responseDateText", "translateSource", "translateTarget",
    "encryptedReviewData", "reviewProviderText", "reviewPositives", "reviewNegatives",
    "reviewerInfo",
]
KEPT_FIELDS = ["overallByProviders"]
RECORD_FIELDS = TOP_FIELDS + COMMENT_FIELDS + KEPT_FIELDS
# Bound to text columns as they are: the walk that takes the other fields takes these as text at once.
TEXT_FIELDS = [
    "ratingText", "reviewTitle", "reviewComments", "reviewPositives", "reviewNegatives", "checkInDateMonthAndYear",
    "responderName", "responseDateText", "translateSource", "translateTarget", "encryptedReviewData", "reviewProviderText",
]
# Taken with the record's shape, in one walk over the line; the others apart from them, where a query reads any.
FIRST_FIELDS = ["hotelId", "platform", "hotelName", "hotelReviewId", "rating"]

MSG_RATING = "Rating must be between 0 and 10"
MSG_HOTEL_ID = "Hotel ID is required"
MSG_PLATFORM = "Platform is required"
MSG_PLATFORM_TYPE = "review.platform.trim is not a function"
MSG_PARSE = "Invalid JSON format"
MSG_NESTED = "JSON nested too deep"   # of this engine: more than js.MOST_NESTED opening brackets, and not parsed
MSG_NULL_RECORD = "Cannot read properties of null (reading 'rating')"
MSG_COMMENT_NULL = "Cannot use 'in' operator to search for 'rating' in null"
MSG_STRICT_NULL = "Data transformation failed: Cannot read properties of null (reading 'hotelId')"
MSG_STRICT_NO_COMMENT = "Data transformation failed: Cannot read properties of {0} (reading 'hotelReviewId')"

LENIENT, STRICT = "lenient", "strict"


class Rec:
    """Accessor for the transformed record, stored as one column per known field.

    ``rec["rating"]`` is the field as a VARIANT (SQL NULL = undefined);
    ``rec.t("rating")`` its JSON type name, ``rec.text("rating")`` / ``rec.num("rating")`` its value as text or double
    if it is a string or number, and ``rec.truthy("rating")`` its truthiness, all computed once per row for the
    fields in TYPED_FIELDS / TRUTHY_FIELDS. ``rec.string("reviewTitle")`` is one of TEXT_FIELDS as a text column receives
    it (js.pg_text).
    """

    def __getitem__(self, name: str) -> Column:
        return F.col(f"r_{name}")

    def t(self, name: str) -> Column:
        return F.col(f"t_{name}")

    def truthy(self, name: str) -> Column:
        return F.col(f"b_{name}")

    def text(self, name: str) -> Column:
        return F.col(f"s_{name}")

    def num(self, name: str) -> Column:
        return F.col(f"n_{name}")

    def string(self, name: str) -> Column:
        return F.col(f"str_{name}")


REC = Rec()
# Fields whose JSON type is consulted by rules and store projections.
TYPED_FIELDS = ["hotelId", "platform", "hotelName", "hotelReviewId", "rating", "reviewDate",
                "providerId", "isShowReviewResponse"]
TRUTHY_FIELDS = ["hotelId", "platform", "hotelName", "hotelReviewId", "rating", "isShowReviewResponse", "reviewDate"]


@dataclass(frozen=True)
class Rule:
    """A record rule: ``fails(rec)`` is a boolean Column over the record accessor.

    ``throws=True`` models a rule whose check raises in the service: the record is
    invalid with that message alone (messages of earlier rules are lost). ``reads`` names the
    fields it reads beside FIRST_FIELDS: they are taken with these (left out, it works as well).
    """

    message: str
    fails: Callable[[Rec], Column]
    throws: bool = False
    reads: tuple[str, ...] = ()


def _rating_out_of_range(rec: Rec) -> Column:
    r = F.col("_rating_num")
    return ~F.isnan(r) & ((r < F.lit(0.0)) | (r > F.lit(10.0)))


def _platform_missing(rec: Rec) -> Column:
    return ~rec.truthy("platform") | (js.is_string(rec["platform"], rec.t("platform")) & js.is_blank(rec.text("platform")))


def _platform_not_text(rec: Rec) -> Column:
    return rec.truthy("platform") & ~js.is_string(rec["platform"], rec.t("platform"))


# The service's business rules, in its order.
RECORD_RULES: list[Rule] = [
    Rule(MSG_RATING, _rating_out_of_range),
    Rule(MSG_HOTEL_ID, lambda rec: ~rec.truthy("hotelId")),
    Rule(MSG_PLATFORM, _platform_missing),
    Rule(MSG_PLATFORM_TYPE, _platform_not_text, throws=True),
]


def _top_kind(value: Column) -> Column:
    """First significant character of a parsed line: its JSON type ('{', '[', ...)."""
    return F.when(value.startswith("{"), F.lit("{")).otherwise(F.substring(F.ltrim(value, F.lit(" \t\r\n")), 1, 1))


def _object_type(names: list[str], at_top: list[str], in_comment: list[str], as_text: tuple | list = ()) -> str:
    """The members of a record among ``names``, as of a struct type: variants or text, those of its comment in a struct."""
    kind = lambda n: "string" if n in as_text else "variant"
    top = [f"{n}: {kind(n)}" for n in names if n in at_top]
    body = [f"{n}: {kind(n)}" for n in names if n in in_comment]
    return ", ".join(top + ([f"comment: struct<{', '.join(body)}>"] if body else []))


def _first_members(names: list[str], at_top: list[str], in_comment: list[str]) -> dict[str, Column]:
    """The members of the first part as columns of their own (``_top_``, ``_body_``): a struct handed on through
    further fences would be taken apart by Spark, below them, for each one that reads a field of it."""
    obj = F.get(F.col("_parts"), F.lit(0))
    return ({f"_top_{n}": obj[n] for n in names if n in at_top} | {f"_body_{n}": obj["comment"][n] for n in names if n in in_comment})


def _take_members(df: DataFrame, groups: dict[str, list[str]], at_top: list[str], in_comment: list[str], taken: list[str],
                  strings: bool) -> DataFrame:
    """The ``taken`` fields, the first ones' members or from their group's object: from the comment where ``raw``, else from
    the top. With ``strings`` the text fields as text as well, and nothing is taken behind them."""
    def place(n: str, obj: Column | None) -> Column:
        top, body = (F.col(f"_top_{n}"), F.col(f"_body_{n}")) if obj is None else (obj[n], obj["comment"][n])
        return top if n not in in_comment else body if n not in at_top else F.when(F.col("raw"), body).otherwise(top)

    def group(n: str) -> Column | None:
        return next((F.col(g) for g, names in groups.items() if n in names and (g != "_more" or n not in TEXT_FIELDS)), None)

    # Fields extracted: the whole document is not carried further.
    return df.select(*[c for c in df.columns if c not in groups and not c.startswith(("_top_", "_body_")) and not (strings and c == "_w")],
                     *[F.when(F.col("parsed"), place(n, group(n))).alias(f"r_{n}") for n in taken],
                     *[F.when(F.col("parsed"), place(n, F.col("_more"))).alias(f"str_{n}") for n in (TEXT_FIELDS if strings else ())])


def _errors_from_rules(rules: list[Rule]) -> tuple[Column, list[Column]]:
    """(throw message or NULL, ordered errors or NULLs) for one record."""
    thrown = F.lit(None).cast("string")
    for r in reversed([r for r in rules if r.throws]):
        thrown = F.when(r.fails(REC), F.lit(r.message)).otherwise(thrown)
    return thrown, [F.when(r.fails(REC), F.lit(r.message)) for r in rules if not r.throws]


@js.per_context
def _check_stages(policy: str, validate: bool, rules: tuple) -> list[tuple[Callable, dict]]:
    """The stages of check_lines as (function, its arguments) (built once).

    The line stays inside its wrapped parse (``_w``, at $[0]), which is never copied out.
    """
    stages: list[tuple[Callable, dict]] = []
    line, w, parts = F.col("value"), F.col("_w"), F.col("_parts")
    # Where the policy looks for a field: lenient in both places, strict in one.
    at_top = TOP_FIELDS + KEPT_FIELDS + ([] if policy == STRICT and validate else COMMENT_FIELDS)
    in_comment = [] if policy == STRICT and not validate else COMMENT_FIELDS
    first = [n for n in RECORD_FIELDS if n in FIRST_FIELDS or any(n in r.reads for r in rules)]
    others = [n for n in RECORD_FIELDS if n not in first]
    groups = {"_kept": [n for n in others if n in KEPT_FIELDS], "_texts": [n for n in others if n in TEXT_FIELDS],
              "_more": [n for n in others if n not in KEPT_FIELDS and n not in TEXT_FIELDS] + TEXT_FIELDS}
    # The service's own rules read first fields alone: the others are taken behind them, so that the rules' rows stay narrow.
    late = not validate or all(r in RECORD_RULES for r in rules)
    early = ["hotelId", "platform", "rating"] if late else TYPED_FIELDS
    stages.append((js.fence, dict(blank=F.when(line.startswith("{"), F.lit(False)).otherwise(js.is_blank(line)),
                                  _kind=_top_kind(line))))
    stages.append((js.fence, dict(_w=F.when(~F.col("blank"), js.strict_wrap(line)))))
    stages.append((js.fence, dict(_parts=js.strict_parts(w, _object_type(first, at_top, in_comment)))))
    in_object = F.get(parts, F.lit(0))["comment"].isNotNull() if in_comment else F.lit(False)
    stages.append((js.fence, dict(parsed=js.strict_whole(parts), _in_object=in_object, **_first_members(first, at_top, in_comment))))
    kind, parsed = F.col("_kind"), F.col("parsed")
    is_obj = parsed & (kind == "{")
    is_null = parsed & (kind == "n")
    truthy_top = F.when(kind.isin("{", "["), F.lit(True)).otherwise(js.truthy(js.field(w, "$[0]")))
    # A comment that is no object: of interest if it is null or absent.
    if in_comment:
        stages.append((js.fence, dict(_comment=F.when(is_obj & ~F.col("_in_object"), F.try_variant_get(
            w, "$[0]", "struct<comment: variant>")["comment"]))))
    comment_null = F.coalesce(F.is_variant_null(F.col("_comment")), F.lit(False))

    if policy == LENIENT:
        # isRawFormat: object, has `comment` (object), `rating` in comment.
        stages.append((js.fence, dict(raw=is_obj & F.col("_body_rating").isNotNull())))
        raw = F.col("raw")
        transform_error = F.when(is_obj & ~raw & comment_null, F.lit(MSG_COMMENT_NULL))
        null_error = F.when(is_null, F.lit(MSG_NULL_RECORD)) if validate else F.lit(None).cast("string")
        pre, rec_truthy = F.coalesce(transform_error, null_error), parsed & (raw | truthy_top)
    elif validate:  # strict, validation on: always flatten from `comment`
        stages.append((js.fence, dict(raw=parsed)))
        missing = F.col("_comment").isNull() | comment_null
        pre = F.when(parsed, F.when(is_null, F.lit(MSG_STRICT_NULL))
                     .when(~F.col("_in_object") & missing, F.lit(MSG_STRICT_NO_COMMENT)))
        rec_truthy = parsed
    else:  # strict, validation off: the parsed value passes untouched
        stages.append((js.fence, dict(raw=F.lit(False))))
        pre, rec_truthy = F.lit(None).cast("string"), parsed & truthy_top
    stages.append((js.fence, dict(_pre=pre, rec_truthy=rec_truthy)))

    def take(taken: list[str], typed: list[str], from_groups: bool) -> None:
        """The ``taken`` fields with the types, texts, numbers and truthiness of the ``typed`` ones. Projections: nobody
        pushes a filter below the fences around them, and what a query never reads is pruned."""
        # One walk over the object takes all members of a group; the comment itself is never copied out.
        if from_groups:
            stages.append((js.project, {g: F.when(parsed, F.try_variant_get(
                w, "$[0]", f"struct<{_object_type(names, at_top, in_comment, TEXT_FIELDS if g == '_more' else ())}>"))
                for g, names in groups.items() if names}))
        stages.append((_take_members, dict(groups=groups, at_top=at_top, in_comment=in_comment, taken=taken, strings=from_groups)))
        stages.append((js.project, {f"t_{n}": js.vtype(REC[n]) for n in typed}))
        stages.append((js.project, {f"s_{n}": js.as_string(REC[n], REC.t(n)) for n in typed}
                       | {f"n_{n}": js.as_double(REC[n], REC.t(n)) for n in typed}))
        if late and from_groups:
            stages.append((js.parted, {}))
        stages.append((js.project, {f"b_{n}": js.truthy(REC[n], REC.t(n), REC.text(n), REC.num(n)) for n in typed if n in TRUTHY_FIELDS}))

    take(first if late else RECORD_FIELDS, early, not late)
    stages.append((js.project, {"_rating_num": js.js_number(REC["rating"], REC.t("rating"), REC.text("rating"), REC.num("rating"))}))
    if validate:
        thrown, errs = _errors_from_rules(list(rules))
    else:
        thrown, errs = F.lit(None).cast("string"), []
    # One error alone (of the parse, the shape or a rule that throws), or all that the rules found.
    alone = (
        F.when(~F.col("parsed"), F.when(
            F.length("value") - F.length(F.translate("value", "[{", "")) > js.MOST_NESTED, F.lit(MSG_NESTED))
            .otherwise(F.lit(MSG_PARSE)))
        .when(F.col("_pre").isNotNull(), F.col("_pre"))
        .otherwise(thrown)
    )
    stages.append((js.fence, {"_alone": F.when(~F.col("blank"), alone)}))
    listed = ~F.col("blank") & F.col("_alone").isNull()
    stages.append((js.compact_fence, {"name": "_listed", "items": [F.when(listed, e) for e in errs]}))
    stages.append((js.fence, {"errors": F.when(~F.col("blank"), F.when(
        F.col("_alone").isNotNull(), F.array("_alone")).otherwise(F.col("_listed")))}))
    stages.append((js.fence, {"is_valid": F.when(~F.col("blank"), F.size("errors") == 0)}))
    if late:
        take(others, [n for n in TYPED_FIELDS if n not in early], True)
    return stages


def check_lines(lines: DataFrame, policy: str = LENIENT, validate: bool = True,
                rules: list[Rule] | None = None) -> DataFrame:
    """Parse, flatten and validate every line.

    Adds: ``blank``, ``parsed`` (strict JSON ok), ``raw`` (nested review shape), ``r_<field>`` / ``t_<field>`` / ``s_<field>`` /
    ``n_<field>`` / ``b_<field>`` (transformed record, field types, texts, numbers and truthiness), ``str_<field>`` (TEXT_FIELDS
    as text columns receive them), ``rec_truthy``, ``errors ARRAY<STRING>``,
    ``is_valid`` (NULL for blank lines). Each stage is fenced so every value is computed once per row.
    """
    if policy not in (LENIENT, STRICT):
        raise ValueError(f"unknown policy {policy!r}")
    rules = RECORD_RULES if rules is None else rules
    df = lines
    for add, stage in _check_stages(policy, validate, tuple(rules)):
        df = add(df, **stage)
    return df.drop("_kind", "_parts", "_in_object", "_comment", "_pre", "_rating_num", "_alone", "_listed")


def file_counts(checked: DataFrame) -> DataFrame:
    """Per-file line counters: total (incl. blank), valid, invalid."""
    return checked.groupBy("file").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("is_valid")).alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("invalid_records"),
    )


def valid_records(checked: DataFrame, collect_guard: bool = True) -> DataFrame:
    """Valid transformed records (K7); with ``collect_guard`` falsy records are dropped (F16)."""
    df = checked.filter(F.col("is_valid"))
    if collect_guard:
        df = df.filter(F.col("rec_truthy"))
    return df


# Reviewer sub-record fields (name -> SQL type) of the review feed.
REVIEWER_FIELDS = {
    "countryName": "string", "displayMemberName": "string", "flagName": "string",
    "reviewGroupName": "string", "roomTypeName": "string", "countryId": "bigint",
    "lengthOfStay": "bigint", "reviewGroupId": "bigint", "roomTypeId": "bigint",
    "reviewerReviewedCount": "bigint", "isExpertReviewer": "boolean",
    "isShowGlobalIcon": "boolean", "isShowReviewedCount": "boolean",
}


def reviewers(checked: DataFrame) -> DataFrame:
    """The nested ``reviewerInfo`` of valid records as typed reviewer columns (P12).

    One row per valid record that carries reviewer info; values that do not fit the
    declared type are NULL.
    """
    rv = F.col("_reviewer")
    checked = js.fence(checked.filter("is_valid"), _reviewer=F.col("r_reviewerInfo"))
    return (checked.filter(rv.isNotNull() & ~F.is_variant_null(rv))
            .select("file", "ord", *[F.try_variant_get(rv, f"$.{k}", t).alias(k)
                                     for k, t in REVIEWER_FIELDS.items()]))
