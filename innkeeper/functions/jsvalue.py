"""JavaScript value semantics over Spark VARIANT columns.

The reviewed service parses each line with a strict JSON parser and then applies
JavaScript operators (truthiness, ``Number()``, ``parseFloat``, ``new Date``) to the
dynamic object. Every helper here returns a JVM-side Column expression; there is
no Python UDF anywhere in the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must agree with JavaScript / PostgreSQL behaviour)
# ---------------------------------------------------------------------------
# Characters removed by String.prototype.trim(): ASCII white space, every
# Unicode space separator (Zs, Zl, Zp) and the byte-order mark.
JS_SPACE = r"[\s\p{Z}\x{FEFF}]"
# A decimal literal accepted by Number(); hex handled separately.
JS_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
JS_INFINITY = r"^[+-]?Infinity$"
JS_HEX = r"^0[xX][0-9a-fA-F]+$"
# parseFloat() reads the longest numeric prefix after leading white space.
JS_FLOAT_PREFIX = r"^[\s\p{Z}\x{FEFF}]*([+-]?(Infinity|\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?))"
# PostgreSQL numeric input: optional sign, digits with optional point, exponent.
PG_NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
PG_INTEGER = r"^\s*[+-]?\d+\s*$"
INT32_MIN, INT32_MAX = -2147483648, 2147483647
# new Date(text): month names by their first three letters; zones by name, in hours.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
ZONE_HOURS = {"gmt": 0, "utc": 0, "ut": 0, "z": 0, "est": -5, "edt": -4, "cst": -6, "cdt": -5,
              "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}
DAYS = "sun mon tue wed thu fri sat"
# An ISO date, alone (then UTC) or with a time.
ISO_DATE = r"^\d{4}(-\d{2}(-\d{2})?)?([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?)?$"
CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?\s*([aApP][mM])?"
OFFSET = r"([+-])(\d{2}):?(\d{2})\s*(?:\(.*\))?$"
# Nesting that the JSON parser here takes; deeper lines are rejected with a message of their own.
MOST_NESTED = 1000
NUMERIC_TYPE = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"

def _try_cast(c: Column, t: str) -> Column:
    return c.try_cast(t)


def _nan() -> Column:
    return F.lit(float("nan"))


# ---------------------------------------------------------------------------
# Parsing
# ---------------------------------------------------------------------------
def strict_wrap(line: Column) -> Column:
    """Parse ``[line,{"§":{}}]``: the one JSON parse per line (see strict_parse)."""
    return F.try_parse_json(F.concat(F.lit("["), line, F.lit(',{"§":{}}]')))


def strict_parts(w: Column, members: str = "") -> Column:
    """The elements of a wrapped parse as objects with the named ``members`` (of a struct type) and the sentinel's.

    An element that is no object is NULL, as is a member that is absent. One walk for all: a path that leads nowhere
    costs an exception inside Spark, a member that is not there does not.
    """
    return F.try_variant_get(w, "$", f"array<struct<{members}{', ' if members else ''}`§`: variant>>")


def strict_whole(parts: Column) -> Column:
    """Whether the parts (strict_parts) are one whole value, the first, and the sentinel: JSON.parse would not throw."""
    return F.coalesce((F.size(parts) == 2) & F.get(parts, F.lit(1))["§"].isNotNull(), F.lit(False))


def strict_ok(w: Column) -> Column:
    """Whether a wrapped parse holds one whole value (at $[0]): JSON.parse would not throw."""
    return strict_whole(strict_parts(w))


def strict_unwrap(w: Column) -> Column:
    """The line's value from a wrapped parse; SQL NULL when JSON.parse would throw."""
    return F.when(strict_ok(w), F.variant_get(w, "$[0]", "variant"))


def strict_parse(line: Column) -> Column:
    """Parse one line as strict RFC-8259 JSON; SQL NULL when JSON.parse would throw.

    ``try_parse_json`` tolerates trailing garbage after the first value, so the line is
    wrapped in an array with a sentinel second element: the wrapper only parses into
    exactly two elements with the sentinel second when the line is one whole value.
    The wrapped value is referenced three times: evaluate ``strict_wrap`` once (a
    fence) and ``strict_unwrap`` its result when parsing many rows.
    """
    return strict_unwrap(strict_wrap(line))


def is_blank(s: Column) -> Column:
    """``s.trim() === ""`` with JavaScript's white-space set."""
    return s.rlike("^" + JS_SPACE + "*$")


def js_trim(s: Column) -> Column:
    return F.regexp_replace(s, "^" + JS_SPACE + "+|" + JS_SPACE + "+$", "")


# ---------------------------------------------------------------------------
# Type inspection
# ---------------------------------------------------------------------------
def vtype(x: Column) -> Column:
    """Type name of a variant value; SQL NULL when the path is missing (undefined)."""
    return F.schema_of_variant(x)


def field(v: Column, path: str) -> Column:
    """``obj.a.b`` as a variant; SQL NULL when any step is missing (``undefined``)."""
    return F.variant_get(v, path, "variant")


def present(x: Column) -> Column:
    """``x !== undefined``: JSON null counts as present."""
    return x.isNotNull()


def is_null_or_undefined(x: Column) -> Column:
    return x.isNull() | F.coalesce(F.is_variant_null(x), F.lit(False))


def is_string(x: Column, t: Column | None = None) -> Column:
    t = vtype(x) if t is None else t
    return F.coalesce(t == "STRING", F.lit(False))


def is_numeric(t: Column) -> Column:
    """Whether a type name is one of NUMERIC_TYPE, by comparisons alone."""
    return t.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE") | t.startswith("DECIMAL")


def is_number(x: Column, t: Column | None = None) -> Column:
    t = vtype(x) if t is None else t
    return F.coalesce(is_numeric(t), F.lit(False))


def is_boolean(x: Column, t: Column | None = None) -> Column:
    t = vtype(x) if t is None else t
    return F.coalesce(t == "BOOLEAN", F.lit(False))


def is_container(x: Column) -> Column:
    t = vtype(x)
    return F.coalesce(t.startswith("OBJECT") | t.startswith("ARRAY"), F.lit(False))


def as_string(x: Column, t: Column | None = None) -> Column:
    """String value of a variant string (NULL for other types)."""
    return F.when(is_string(x, t), F.variant_get(x, "$", "string"))


def as_double(x: Column, t: Column | None = None) -> Column:
    """Value of a variant number as a double (NULL for other types)."""
    return F.when(is_number(x, t), F.try_variant_get(x, "$", "double"))


def _scalars(x: Column, text: Column | None, num: Column | None) -> tuple[Column, Column]:
    """x as text and as a double: what is at hand (as_string, as_double) or taken from the variant.

    Spark builds a cast for each value it takes, and takes it anew wherever an expression names it: a value
    named more than once is computed by a column of its own.
    """
    return (F.variant_get(x, "$", "string") if text is None else text,
            F.try_variant_get(x, "$", "double") if num is None else num)


def truthy(x: Column, t: Column | None = None, text: Column | None = None, num: Column | None = None) -> Column:
    """JavaScript truthiness: false for undefined, null, false, 0, NaN and ""."""
    t = vtype(x) if t is None else t
    text, num = _scalars(x, text, num)
    return (
        F.when(x.isNull(), F.lit(False))
        .when(t == "VOID", F.lit(False))
        .when(t == "STRING", text != F.lit(""))
        .when(t == "BOOLEAN", F.variant_get(x, "$", "boolean"))
        .when(t.startswith("OBJECT") | t.startswith("ARRAY"), F.lit(True))
        .otherwise(F.coalesce(num != F.lit(0.0), F.lit(False)))
    )


# ---------------------------------------------------------------------------
# Coercions
# ---------------------------------------------------------------------------
def js_string_to_number(s: Column) -> Column:
    """``Number(s)`` for a string: trimmed decimal / Infinity / hex, "" -> 0, else NaN."""
    t = js_trim(s)
    return (
        F.when(t == "", F.lit(0.0))
        .when(t.rlike(JS_DECIMAL), _try_cast(t, "double"))
        .when(t.rlike(JS_INFINITY),
              F.when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .when(t.rlike(JS_HEX), _hex_value(t))
        .otherwise(_nan())
    )


def _hex_value(t: Column) -> Column:
    """Value of 0x... text of any length, as a double."""
    digits = F.split(F.lower(F.substring(t, 3, 2 ** 31 - 1)), "")
    return F.aggregate(digits, F.lit(0.0), lambda v, d: F.when(d == "", v).otherwise(
        v * 16 + F.instr(F.lit("0123456789abcdef"), d) - 1))


def js_number(x: Column, t: Column | None = None, text: Column | None = None, num: Column | None = None) -> Column:
    """``Number(x)`` / the implicit coercion of ``x < 0``.

    undefined -> NaN, null -> 0, booleans -> 0/1, strings as above, objects -> NaN;
    an array through its string form: [] -> 0, one number, string or null -> that element's
    text, anything else -> NaN.
    """
    t = vtype(x) if t is None else t
    text, num = _scalars(x, text, num)
    one = F.try_variant_get(x, "$[0]", "variant")
    alone = one.isNotNull() & F.try_variant_get(x, "$[1]", "variant").isNull()
    kind = vtype(one)
    from_array = (F.when(one.isNull(), F.lit(0.0)).when(alone & (kind == "VOID"), F.lit(0.0))
                  .when(alone & is_numeric(kind), F.try_variant_get(one, "$", "double"))
                  .when(alone & (kind == "STRING"), js_string_to_number(F.variant_get(one, "$", "string")))
                  .otherwise(_nan()))
    return (
        F.when(x.isNull(), _nan())
        .when(t == "VOID", F.lit(0.0))
        .when(t == "BOOLEAN", F.when(F.variant_get(x, "$", "boolean"), F.lit(1.0)).otherwise(F.lit(0.0)))
        .when(t == "STRING", js_string_to_number(text))
        .when(is_numeric(t), num)
        .when(t.startswith("ARRAY"), from_array)
        .otherwise(_nan())
    )


def js_parse_float(s: Column) -> Column:
    """``parseFloat(s)``: longest numeric prefix, NaN when there is none."""
    m = F.regexp_extract(s, JS_FLOAT_PREFIX, 1)
    return (
        F.when(m == "", _nan())
        .when(m.endswith("Infinity"),
              F.when(m.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .otherwise(_try_cast(m, "double"))
    )


def is_nan_or_inf(d: Column) -> Column:
    return F.isnan(d) | (F.abs(d) == F.lit(float("inf")))


def per_context(fn):
    """Memoize a builder of Column expressions per running SparkContext.

    Column expressions here are unresolved (they name columns, not plan nodes), so
    one tree serves every DataFrame of the session; building it costs thousands of
    Py4J round trips.
    """
    cache: dict = {}

    def wrapper(*args):
        from pyspark import SparkContext
        sc = SparkContext._active_spark_context
        key = (sc.applicationId if sc is not None else None, args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]

    wrapper.__wrapped__ = fn
    wrapper.__doc__ = fn.__doc__
    return wrapper


def fence(df, **cols: Column):
    """Add computed columns evaluated exactly once per row.

    Catalyst substitutes alias definitions into every consumer and into filters it
    pushes down, so a value referenced by many later expressions (a parsed JSON
    document, a type name) would be recomputed at each reference. Producing the
    columns through a one-element ``inline`` generator makes them generator
    outputs: later filters stop above it and consumers read the computed value.
    """
    names = list(cols)
    return df.select("*", F.inline(F.array(F.struct(*[cols[n].alias(n) for n in names]))))


def parted(df):
    """Ends the method that Spark makes of a run of projections: the next ones are in another (see compact_fence, packed)."""
    return fence(df, _parted=F.lit(True)).drop("_parted")


def project(df, **cols: Column):
    """Add computed columns by a projection: what a query never reads is pruned. For expressions with lambda functions
    (``transform``, ``aggregate``, ``array_compact``): a generator that holds one is interpreted whole, a projection compiles
    all but the lambda. Put a fence above it, so that no filter is pushed through with its own copy."""
    return df.select("*", *[c.alias(n) for n, c in cols.items()])


def packed(df, *needed: Column):
    """``df``'s row in one column, ``_row``, beside the ``needed`` ones: what computes on a few columns of a wide row hands
    on two values instead of all. (Spark makes a method of each operator and a parameter or two of each column; the JVM's
    second compiler takes no method with more parameters than its frame holds, and leaves it to the first one.)"""
    return df.select(F.array(F.struct("*")).alias("_row"), *needed)


def unpacked(df, *made: str | Column):
    """The packed row's columns and the ``made`` ones. By a generator: Spark would take a struct apart below the
    operators between."""
    return df.select(F.inline("_row"), *made)


FEW_ITEMS = 8   # more of them, taken one by one, would make a method too long for the JVM to compile


def compact_fence(df, name: str, items: list[Column], between: str | None = None):
    """``name``: the items that are not NULL, as an array (text). A few are taken one by one, many by a lambda for
    rows with any: its projection ends the compiled stage, and the row is written out. ``between``: a character that no
    item's text holds; then they are joined by it and split again, few or many."""
    none = F.array().cast("array<string>")
    if not items:
        return fence(df, **{name: none})
    if between is not None:
        df = fence(df, _joined=F.concat_ws(between, *items))
        return fence(df, **{name: F.when(F.col("_joined") != "", F.split("_joined", between)).otherwise(none)}).drop("_joined")
    df = fence(df, _items=F.array(*items))
    if len(items) <= FEW_ITEMS:
        item = [F.get(F.col("_items"), F.lit(i)) for i in range(len(items))]
        some = F.flatten(F.array(*[F.when(x.isNotNull(), F.array(x)).otherwise(none) for x in item]))
        return fence(df, **{name: F.when(F.concat_ws("", "_items") != "", some).otherwise(none)}).drop("_items")
    df = project(df, _compact=F.when(F.concat_ws("", "_items") != "", F.array_compact("_items")).otherwise(none))
    return fence(df, **{name: F.col("_compact")}).drop("_items", "_compact")


def pg_text(x: Column, text: Column | None = None) -> Column:
    """Text a JavaScript value becomes when bound to a varchar/text parameter.

    strings as is; numbers and booleans in their literal form; null/undefined -> NULL.
    """
    other = F.try_variant_get(x, "$", "string")
    return other if text is None else F.when(text.isNotNull(), text).otherwise(other)


def pg_int32(x: Column, t: Column | None = None, text: Column | None = None, num: Column | None = None) -> Column:
    """Value an INTEGER column receives from a JS value; NULL when PostgreSQL rejects it.

    numbers must be integral and in range; strings must be integer literals.
    """
    t = vtype(x) if t is None else t
    s, d = _scalars(x, text, num)
    from_num = F.when((d == F.floor(d)) & (d >= INT32_MIN) & (d <= INT32_MAX), d.cast("int"))
    from_str = F.when(s.rlike(PG_INTEGER), _try_cast(F.trim(s), "int"))
    return (
        F.when(is_numeric(t), from_num)
        .when(t == "STRING", from_str)
    )


def double_to_int32(d: Column) -> Column:
    """INTEGER column fed with a JS number (NaN / fractional / out of range -> NULL)."""
    return F.when(~F.isnan(d) & (d == F.floor(d)) & (d >= INT32_MIN) & (d <= INT32_MAX), d.cast("int"))


def to_decimal31(d: Column) -> Column:
    """NUMERIC(3,1) from a double: half-up rounding of its shortest decimal form.

    NULL for NaN, infinities and values that round outside (-100, 100).
    """
    return F.when(~is_nan_or_inf(d), _try_cast(d, "decimal(3,1)"))


def pg_numeric_text(s: Column) -> Column:
    """NUMERIC(3,1) from text the way PostgreSQL reads a numeric literal."""
    return F.when(s.rlike(PG_NUMERIC), _try_cast(F.trim(s), "decimal(3,1)"))


def _int(c: Column) -> Column:
    return F.when(c != "", c.try_cast("int"))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_NAMES = lambda names: "|".join(names.split())
_ZONES = "|".join(sorted(ZONE_HOURS, key=len, reverse=True))
MONTH_WORD = rf"(?<![a-z])({_NAMES(MONTHS)})[a-z]*"
ZONE_WORD = rf"(?<![a-z])({_ZONES})(?![a-z])"
KNOWN_WORDS = rf"(?<![a-z])(?:(?:{_NAMES(MONTHS)}|{_NAMES(DAYS)})[a-z]*|(?:{_ZONES}|t|st|nd|rd|th)(?![a-z]))"


def _legacy_date(t: Column, let=_let) -> Column:
    """Text that is not ISO-8601, lower-cased: seconds since 1970 in UTC, NULL for no date.

    ``let(value, body)`` names a value that body uses more than once: by a lambda function, or by a fence (with_js_date).
    """
    pick = lambda c, rx, k: F.regexp_extract(c, rx, k)

    # Each of these in a value of its own: a method of more than 8,000 bytes would stay interpreted by the JVM.
    def apart(p: Column) -> Column:
        """p: clock, plain (without clock, offset and comment), offset in minutes, month name, zone, numbers."""
        hour, minute, sec = (F.coalesce(_int(pick(p["clock"], CLOCK, k)), F.lit(0)) for k in (1, 2, 3))
        return F.struct(
            F.size(p["numbers"]).alias("n"), *[F.get(p["numbers"], F.lit(k)).alias(x) for k, x in enumerate(("first", "second", "third"))],
            F.when(p["month"] != "", F.floor(F.instr(F.lit(MONTHS), p["month"]) / 4).cast("int") + 1).alias("named"),
            hour.alias("hour"), minute.alias("minute"), sec.alias("sec"), pick(p["clock"], CLOCK, 4).alias("half"),
            p["offset"].alias("offset"), p["zone"].alias("zone"), p["other"].alias("other"))

    def from_parts(p: Column) -> Column:
        n, first, second, third, named = (p[x] for x in ("n", "first", "second", "third", "named"))
        year_first, three = first > 31, named.isNull() & (n == 3)
        month = F.when(named.isNotNull(), named).when(three, F.when(year_first, second).otherwise(first))
        day = (F.when(named.isNotNull() & (n == 1), F.when(year_first, F.lit(1)).otherwise(first))
               .when(named.isNotNull() & (n == 2), F.when(year_first, second).otherwise(first))
               .when(three, F.when(year_first, third).otherwise(second)))
        year = (F.when(named.isNotNull() & (n == 1), F.when(year_first, first).otherwise(F.lit(2001)))
                .when(named.isNotNull() & (n == 2), F.when(year_first, first).otherwise(second))
                .when(three, F.when(year_first, first).otherwise(third)))
        hour = p["hour"]
        return F.struct(
            year.alias("year"), month.alias("month"), day.alias("day"), p["minute"].alias("minute"), p["sec"].alias("sec"),
            F.when(p["half"] == "pm", hour % 12 + 12).when(p["half"] == "am", hour % 12).otherwise(hour).alias("hour"),
            p["offset"].alias("offset"), p["zone"].alias("zone"), p["other"].alias("other"))

    def full_year(d: Column) -> Column:
        year = d["year"]
        return F.struct(F.when(year < 50, year + 2000).when(year < 100, year + 1900).otherwise(year).alias("year"),
                        *[d[x].alias(x) for x in ("month", "day", "minute", "sec", "hour", "offset", "zone", "other")])

    def seconds(d: Column) -> Column:
        zone = F.lit(0)
        for name, h in ZONE_HOURS.items():
            if h:
                zone = F.when(d["zone"] == name, F.lit(60 * h)).otherwise(zone)
        ok = (~d["other"] & d["month"].between(1, 12) & d["day"].between(1, 31) & d["year"].between(1, 9999)
              & (d["hour"] < 24) & (d["minute"] < 60) & (d["sec"] < 60))
        start = F.unix_date(F.make_date(d["year"], d["month"], F.lit(1))).cast("long")
        at = (start + d["day"] - 1) * 86400 + d["hour"] * 3600 + d["minute"] * 60 + d["sec"]
        return F.when(ok, at - F.coalesce(d["offset"], zone) * 60)

    def parts(c: Column) -> Column:
        """c: clock, rest (text without it), sign of the offset."""
        offset = F.when(c["sign"] != "", F.when(c["sign"] == "-", -1).otherwise(1) * (
            _int(pick(c["rest"], OFFSET, 2)) * 60 + _int(pick(c["rest"], OFFSET, 3))))
        bare = F.when(c["sign"] != "", F.regexp_replace(c["rest"], OFFSET, " ")).otherwise(c["rest"])
        return let(F.when(F.contains(bare, F.lit("(")), F.regexp_replace(bare, r"\(.*\)", " ")).otherwise(bare), lambda plain: F.struct(
            c["clock"].alias("clock"), offset.alias("offset"), pick(plain, MONTH_WORD, 1).alias("month"),
            pick(plain, ZONE_WORD, 1).alias("zone"),
            F.rlike(F.regexp_replace(plain, KNOWN_WORDS, ""), F.lit("[a-z]")).alias("other"),
            F.regexp_extract_all(plain, F.lit(r"\d{1,6}"), F.lit(0)).cast("array<int>").alias("numbers")))

    clock = let(pick(t, CLOCK, 0), lambda clock: F.struct(clock.alias("clock"), F.when(
        clock != "", F.regexp_replace(t, CLOCK, " ")).otherwise(t).alias("rest")))
    signed = let(clock, lambda c: F.struct(c["clock"].alias("clock"), c["rest"].alias("rest"), F.when(
        c["clock"] != "", pick(c["rest"], OFFSET, 1)).otherwise("").alias("sign")))
    for body in (parts, apart, from_parts, full_year):
        signed = let(signed, body)
    return let(signed, seconds)


def js_parse_date(s: Column) -> Column:
    """``new Date(text)`` as TIMESTAMP (zone-less text is UTC); NULL for Invalid Date.

    ISO-8601 first. Otherwise a month by name with a day and a year in either order (or the
    year alone: its first day), or numbers as month/day/year or year/month/day; then an
    optional time with AM/PM, a zone name or an offset. Two-digit years are 1950 to 2049, a
    missing one is 2001; days beyond a month's end run on into the next month. Text
    without a date part is no date, nor is text with other words in it.
    """
    t = F.trim(s)
    return F.when(F.rlike(t, F.lit(ISO_DATE)), F.try_to_timestamp(F.replace(t, F.lit(","), F.lit(".")))) \
        .otherwise(F.timestamp_seconds(_let(F.lower(t), lambda x: _legacy_date(x))))


ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(t: Column) -> Column:
    """``lower``, without the tables of Unicode where the text has none of it."""
    return F.when(t.rlike(r"^[\x00-\x7F]*$"), F.translate(t, ASCII_UPPER, ASCII_LOWER)).otherwise(F.lower(t))


def with_js_date(df, name: str, x: Column, t: Column, given: Column):
    """``js_date(x, t)`` as column ``name``, computed by fences instead of lambda functions (``given``: x is truthy)."""
    made: list[str] = []

    def let(value: Column, body) -> Column:
        nonlocal df
        made.append(f"_let{len(made)}")
        df = fence(df, **{made[-1]: value})
        return body(F.col(made[-1]))

    df = packed(df, given.alias("_given"), F.when(given & (t == "STRING"), F.trim(F.variant_get(x, "$", "string"))).alias("_text"),
                F.when(given & is_numeric(t), F.try_variant_get(x, "$", "double"))
                .when(given & (t == "BOOLEAN"), F.lit(1.0)).alias("_ms"))   # a truthy boolean is 1
    text = let(F.col("_text"), lambda c: c)
    iso = let(F.rlike(text, F.lit(ISO_DATE)), lambda c: c)
    seconds = _legacy_date(let(F.when(~iso, _lower(text)), lambda c: c), let)
    ms = let(F.col("_ms"), lambda c: c)
    ts = (F.when(~F.col("_given"), F.timestamp_millis(F.lit(0)))
          .when(iso, F.try_to_timestamp(F.replace(text, F.lit(","), F.lit("."))))
          .when(~iso, F.timestamp_seconds(seconds))
          .when(~is_nan_or_inf(ms) & (F.abs(ms) <= F.lit(8.64e15)), F.timestamp_millis(ms.cast("bigint"))))
    return unpacked(fence(df, _date=ts.cast("timestamp_ntz")), F.col("_date").alias(name))


def js_date(x: Column, t: Column | None = None) -> Column:
    """``x ? new Date(x) : new Date(0)`` as TIMESTAMP_NTZ (UTC); NULL for Invalid Date."""
    t = vtype(x) if t is None else t
    ms = js_number(x, t)
    from_num = F.when(~is_nan_or_inf(ms) & (F.abs(ms) <= F.lit(8.64e15)),
                      F.timestamp_millis(ms.cast("bigint")))
    ts = (
        F.when(~truthy(x, t), F.timestamp_millis(F.lit(0)))
        .when(t == "STRING", js_parse_date(F.variant_get(x, "$", "string")))
        .when(is_numeric(t) | (t == "BOOLEAN"), from_num)
    )
    # The session time zone is pinned to UTC (session.ensure_conf), so this cast
    # yields the UTC wall-clock time a PostgreSQL ``timestamp`` column stores.
    return ts.cast("timestamp_ntz")
