"""Ledger lifecycle and streaming ingest (= batch result, idempotent on restart)."""

import os
import tempfile

from pyspark.sql import functions as F

from innkeeper.operators import ledger, records, store
from innkeeper.operators.tables import TableStore
from innkeeper.sources import bridge, text
from innkeeper.streaming.ingest import run_available

SF = "/root/testdata/sf0.001"


def _ledger_row(spark, status, errors):
    return spark.createDataFrame(
        [("job-1", "a.jl", "agoda", "local", status, 5, 5, 0, 2, 5, 10, errors, None, None, None, None, None)],
        "job_id string, filepath string, platform string, storage_provider string, status string, "
        "total_records int, valid_records int, invalid_records int, hotels_upserted int, reviews_inserted int, "
        "processing_time_ms int, errors array<string>, metadata string, started_at timestamp_ntz, completed_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")


def test_gate(spark):
    req = spark.createDataFrame([("a.jl", "agoda")], "filepath string, platform string")
    jid = req.select(ledger.job_id(F.col("filepath"), F.col("platform"))).first()[0]
    for status, action, result in [("completed", "skip", "already_processed"), ("processing", "reject", "failed"),
                                   ("failed", "rerun", "completed"), ("pending", "rerun", "completed")]:
        led = _ledger_row(spark, status, []).withColumn("job_id", F.lit(jid))
        r = ledger.gate(req, led).first()
        assert (r.action, r.result_status) == (action, result)
    empty = _ledger_row(spark, "completed", []).limit(0)
    assert ledger.gate(req, empty).first().action == "create"


def test_retry_success_keeps_old_errors(spark):
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    led = _ledger_row(spark, "failed", ["boom"])
    upd = spark.createDataFrame([("job-1", "completed", 9, 8, 1, 3, 7, 20, None)],
                                "job_id string, status string, total_records int, valid_records int, "
                                "invalid_records int, hotels_upserted int, reviews_inserted int, processing_time_ms int, errors array<string>")
    r = ledger.transition(led, upd, now).first()
    assert r.status == "completed" and r.errors == ["boom"] and r.total_records == 9
    upd2 = upd.withColumn("status", F.lit("processing"))
    r2 = ledger.transition(led, upd2, now).first()
    assert r2.status == "processing" and r2.total_records == 5 and str(r2.started_at) == "2025-01-01 00:00:00"


def test_stream_equals_batch_and_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="innkeeper-stream-")
    lines = bridge.review_lines(spark, SF)
    text.write_feed(lines, f"{root}/feed", parts=3)
    batches = run_available(spark, f"{root}/feed", f"{root}/store", f"{root}/ckpt")
    assert len(batches) >= 1
    again = run_available(spark, f"{root}/feed", f"{root}/store", f"{root}/ckpt")
    assert again == []
    st = TableStore(spark, f"{root}/store")
    chk = records.check_lines(lines).filter("is_valid")
    exp_r = store.first_reviews(store.review_rows(chk, bridge.request_job_id(F.col("file"))))
    cols = ["hotel_review_id", "hotel_id", "platform", "rating", "review_title", "review_date", "processing_job_id"]
    assert sorted(map(tuple, st.reviews().select(*cols).collect())) == sorted(map(tuple, exp_r.select(*cols).collect()))
    exp_h = store.fold_hotels(store.hotel_rows(chk))
    hcols = store.HOTEL_COLUMNS
    assert sorted(map(tuple, st.hotels().select(*hcols).collect())) == sorted(map(tuple, exp_h.select(*hcols).collect()))
    counts = st.counters().groupBy().sum("total_records").first()[0]
    assert counts == lines.count()


def test_stream_many_batches_merges_across_batches(spark):
    root = tempfile.mkdtemp(prefix="innkeeper-stream2-")
    os.makedirs(f"{root}/feed/file=a")
    os.makedirs(f"{root}/feed/file=b")
    with open(f"{root}/feed/file=a/part-0.txt", "w") as f:
        f.write('{"hotelId":1,"platform":"agoda","hotelName":"A","hotelReviewId":5,"rating":7,"reviewTitle":"first"}\n')
    batches = run_available(spark, f"{root}/feed", f"{root}/store", f"{root}/ckpt")
    with open(f"{root}/feed/file=b/part-0.txt", "w") as f:
        f.write('{"hotelId":1,"platform":"booking","hotelName":"B","hotelReviewId":5,"rating":7,"reviewTitle":"second"}\n')
    batches += run_available(spark, f"{root}/feed", f"{root}/store", f"{root}/ckpt")
    assert len(batches) == 2
    st = TableStore(spark, f"{root}/store")
    h = st.hotels().first()
    assert (h.platform, h.hotel_name) == ("agoda", "B")
    r = st.reviews().collect()
    assert [x.review_title for x in r] == ["first"]
