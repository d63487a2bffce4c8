"""Schema conformance report: per record, the fields that are missing or of the wrong type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsvalue as js

# JSON type names -> test on schema_of_variant's type name
_TYPE_TEST = {
    "number": lambda t: t.rlike(js.NUMERIC_TYPE),
    "string": lambda t: t == "STRING",
    "boolean": lambda t: t == "BOOLEAN",
    "object": lambda t: t.startswith("OBJECT"),
    "array": lambda t: t.startswith("ARRAY"),
}


def schema_report(df: DataFrame, value: str, expected: dict[str, str]) -> DataFrame:
    """Adds ``ok`` and ``problems`` (text) for the JSON document in column ``value``.

    ``expected`` maps a top-level field to one of number/string/boolean/object/array.
    A line that is not strict JSON reports the parse error alone.
    """
    out = js.fence(df, _w=js.strict_wrap(F.col(value)))
    out = js.fence(out, _v=js.strict_unwrap(F.col("_w"))).drop("_w")
    fields = {f"_f{i}": js.field(F.col("_v"), f"$.{name}") for i, name in enumerate(expected)}
    out = js.fence(out, **fields)
    out = js.fence(out, **{f"_t{i}": js.vtype(F.col(f"_f{i}")) for i in range(len(expected))})
    checks = []
    for i, (name, typ) in enumerate(expected.items()):
        t = F.col(f"_t{i}")
        checks.append(F.when(F.col(f"_f{i}").isNull(), F.lit(f"{name}: missing"))
                      .when(~_TYPE_TEST[typ](t), F.concat(F.lit(f"{name}: expected {typ}, got "), F.lower(t))))
    problems = F.when(F.col("_v").isNull(), F.array(F.lit("Invalid JSON format"))) \
                .otherwise(F.array_compact(F.array(*checks)))
    out = out.withColumn("_p", problems)
    drop = ["_v"] + list(fields) + [f"_t{i}" for i in range(len(expected))]
    return out.select(*[c for c in df.columns], (F.size("_p") == 0).alias("ok"),
                      F.array_join("_p", "; ").alias("problems")).drop(*[d for d in drop if d in df.columns])
