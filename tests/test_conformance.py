"""Schema conformance report and the object-store (strict, LF-only) read policy."""

import json
import os
import tempfile

from innkeeper.operators import records
from innkeeper.operators.conformance import schema_report
from innkeeper.sources import text


def test_schema_report(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"k": "5"}'), (3, '{"j": 1}'), (4, '{"k": 5')],
                               "id int, value string")
    got = {r.id: (r.ok, r.problems) for r in schema_report(df, "value", {"k": "number"}).collect()}
    assert got[1] == (True, "")
    assert got[2] == (False, "k: expected number, got string")
    assert got[3] == (False, "k: missing")
    assert got[4] == (False, "Invalid JSON format")


def test_strict_policy_on_object_store_lines(spark):
    d = tempfile.mkdtemp(prefix="innkeeper-s3-")
    nested = [json.dumps({"hotelId": i, "platform": "expedia", "hotelName": "H",
                          "comment": {"hotelReviewId": i, "rating": 6}}) for i in range(1, 57)]
    p = os.path.join(d, "bulk_56.jl")
    with open(p, "w", newline="") as f:
        f.write("\r\n".join(nested) + "\r\n")
    lines = text.read_lines(spark, [p], line_sep="\n").drop("_split", "_mid")
    r = records.file_counts(records.check_lines(lines, policy=records.STRICT)).collect()[0]
    assert (r.total_records, r.valid_records, r.invalid_records) == (56, 56, 0)
    flat = spark.createDataFrame([("f", 0, '{"hotelId":1,"platform":"a","rating":5}')], "file string, i int, value string")
    from pyspark.sql import functions as F
    flat = flat.select("file", F.struct("i").alias("ord"), "value")
    e = records.check_lines(flat, policy=records.STRICT).first().errors
    assert e[0].startswith("Data transformation failed")
