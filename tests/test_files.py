"""Hand-written JSONL fixtures: counts per file, exact line numbers, admission."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from innkeeper.operators import ledger, ordinal, records
from innkeeper.sources import text


def good(i):
    return json.dumps({"hotelId": i, "platform": "agoda", "hotelName": f"H{i}",
                       "comment": {"hotelReviewId": 100 + i, "rating": 7.5, "reviewDate": "2024-01-02"}})


def write(d, name, lines, end="\n"):
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(end.join(lines) + (end if lines else ""))
    return p


def fixtures():
    d = tempfile.mkdtemp(prefix="innkeeper-fx-")
    paths = {
        "valid": write(d, "valid.jl", [good(i) for i in range(1, 6)]),
        "invalid": write(d, "invalid.jl", [
            good(1), '{"hotelId": 2, "platform": "agoda"', json.dumps({"hotelId": 3, "platform": ""}),
            good(4), json.dumps({"hotelId": 5, "platform": "agoda", "rating": 11}), good(6)]),
        "empty": write(d, "empty.jl", []),
        "blank": write(d, "blank_lines.jl", [good(1), "", good(2), "   ", good(3), " ", good(4)], end="\r\n"),
        "missing": os.path.join(d, "missing.jl"),
    }
    return d, paths


def test_counts_per_file(spark):
    _, p = fixtures()
    files = [p["valid"], p["invalid"], p["empty"], p["blank"]]
    chk = records.check_lines(text.read_lines(spark, files).drop("_split", "_mid"))
    got = {os.path.basename(r.file): (r.total_records, r.valid_records, r.invalid_records)
           for r in records.file_counts(chk).collect()}
    assert got["valid.jl"] == (5, 5, 0)
    assert got["invalid.jl"] == (6, 3, 3)
    assert got["blank_lines.jl"] == (7, 4, 0)
    assert "empty.jl" not in got   # empty files vanish from groupBy; the manifest join reports 0/0/0


def test_exact_line_numbers_of_rejects(spark):
    _, p = fixtures()
    lines = text.read_lines(spark, [p["invalid"], p["blank"]])
    chk = records.check_lines(lines)
    bad = chk.filter(~F.col("is_valid"))
    out = ordinal.number_by_splits(chk, keep=bad)
    got = sorted((os.path.basename(r.file), r.line_no) for r in out.collect())
    assert got == [("invalid.jl", 2), ("invalid.jl", 3), ("invalid.jl", 5)]


def test_line_numbers_invariant_to_split_size(spark):
    d = tempfile.mkdtemp(prefix="innkeeper-big-")
    n = 5000
    path = write(d, "big.jl", [good(i) if i % 7 else "{" for i in range(1, n + 1)])
    expected = [i for i in range(1, n + 1) if i % 7 == 0]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ["16k", "128m"]:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            chk = records.check_lines(text.read_lines(spark, [path]))
            out = ordinal.number_by_splits(chk, keep=chk.filter(~F.col("is_valid")))
            assert sorted(r.line_no for r in out.collect()) == expected
            out2 = ordinal.number_by_order(chk, "file", "ord", keep_filter=~F.col("is_valid"))
            assert sorted(r.line_no for r in out2.collect()) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_admission_with_real_listing(spark):
    _, p = fixtures()
    req = spark.createDataFrame([
        (p["valid"], "agoda", "local"), (p["missing"], "agoda", "local"),
        (p["empty"], "agoda", "s3"), (p["valid"], "agoda", "s3"),
        (p["valid"], "airbnb", "local"), (p["valid"], "agoda", "ftp"),
    ], "filepath string, platform string, storage_provider string")
    listing = text.request_listing(spark, req)
    got = [(r.admitted, r.error) for r in ledger.admission(req, listing).collect()]
    assert sorted(got, key=str) == sorted([
        (True, None), (False, ledger.MSG_NOT_VALID), (False, ledger.MSG_NOT_VALID), (True, None),
        (False, ledger.MSG_PLATFORM), (False, ledger.MSG_PROVIDER)], key=str)


def test_numbers_by_order_keep_every_row(spark):
    """A frame with a payload, in many partitions: no row is lost and no number is wrong."""
    n = 200_000
    df = spark.range(n).select((F.col("id") % 3).cast("string").alias("file"), F.col("id").alias("ord"),
                               F.repeat(F.lit("x"), 50).alias("payload"))
    for coalesce in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        out = ordinal.number_by_order(df, "file", "ord")
        assert out.count() == n and out.where(F.col("line_no") != F.floor(F.col("ord") / 3) + 1).count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
