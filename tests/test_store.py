"""Merge semantics of the store stage (upsert last-wins, insert-ignore first-storable-wins)."""

import json

from pyspark.sql import functions as F

from innkeeper.operators import records, store


def line(**kw):
    d = {"platform": "agoda", "rating": 8}
    d.update(kw)
    return json.dumps(d)


def _tables(spark, lines_of, lines):
    chk = records.check_lines(lines_of(lines)).filter("is_valid")
    hotels = store.fold_hotels(store.hotel_rows(chk))
    reviews = store.first_reviews(store.review_rows(chk, F.lit("job-x")))
    return hotels, reviews


def test_hotel_last_wins_keeps_first_platform(spark, lines_of):
    lines = [
        line(hotelId=7, platform="agoda", hotelName="A", hotelReviewId=1,
             overallByProviders=[{"overallScore": 8.1, "reviewCount": 3, "grades": {"c": 1}}]),
        line(hotelId=7, platform="booking", hotelName="B", hotelReviewId=2),
    ]
    hotels, _ = _tables(spark, lines_of, lines)
    h = hotels.collect()
    assert len(h) == 1
    h = h[0]
    assert (h.platform, h.hotel_name, h.overall_score, h.review_count, h.grades) == ("agoda", "B", None, 0, "{}")


def test_hotel_without_name_still_stores_review(spark, lines_of):
    hotels, reviews = _tables(spark, lines_of, [line(hotelId=3, hotelName=None, hotelReviewId=4)])
    assert hotels.count() == 0 and reviews.count() == 1


def test_review_first_storable_wins(spark, lines_of):
    lines = [
        line(hotelId=1, hotelReviewId=5, reviewTitle="x" * 501),
        line(hotelId=1, hotelReviewId=5, reviewTitle="second"),
        line(hotelId=1, hotelReviewId=5, reviewTitle="third"),
        line(hotelId=1, hotelReviewId=6, reviewTitle="x"),
        line(hotelId=1, hotelReviewId=6, reviewTitle="y"),
    ]
    _, reviews = _tables(spark, lines_of, lines)
    got = {r.hotel_review_id: r.review_title for r in reviews.collect()}
    assert got == {5: "second", 6: "x"}


def test_coercions(spark, lines_of):
    lines = [
        line(hotelId=1, hotelReviewId=1, rating=8.25),
        line(hotelId=1, hotelReviewId=2, rating="8.5abc"),
        line(hotelId=1, hotelReviewId=3),
        line(hotelId=1, hotelReviewId=4, reviewDate="not a date"),
        line(hotelId=1, hotelReviewId=5, reviewDate="April 10, 2025"),
        line(hotelId="0", hotelReviewId=6),
        line(hotelId=1, hotelReviewId=7, providerId="12", isShowReviewResponse="false"),
    ]
    _, reviews = _tables(spark, lines_of, lines)
    got = {r.hotel_review_id: r for r in reviews.collect()}
    assert float(got[1].rating) == 8.3
    assert float(got[2].rating) == 8.5
    assert str(got[3].review_date) == "1970-01-01 00:00:00"
    assert 4 not in got
    assert str(got[5].review_date) == "2025-04-10 00:00:00"
    assert got[6].hotel_id == 0
    assert got[7].provider_id == 12 and got[7].is_show_review_response is True


def test_merge_against_existing(spark, lines_of):
    ts1 = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    ts2 = F.lit("2025-01-02 00:00:00").cast("timestamp_ntz")
    h1, r1 = _tables(spark, lines_of, [line(hotelId=1, hotelName="A", hotelReviewId=1, reviewTitle="old")])
    h2, r2 = _tables(spark, lines_of, [line(hotelId=1, platform="booking", hotelName="B", hotelReviewId=1,
                                            reviewTitle="new"),
                                       line(hotelId=2, hotelName="C", hotelReviewId=2)])
    existing_h = h1.select(*store.HOTEL_COLUMNS, ts1.alias("created_at"), ts1.alias("updated_at"))
    merged = {r.hotel_id: r for r in store.merge_hotels(existing_h, h2, ts2).collect()}
    assert merged[1].platform == "agoda" and merged[1].hotel_name == "B"
    assert str(merged[1].created_at) == "2025-01-01 00:00:00" and str(merged[1].updated_at) == "2025-01-02 00:00:00"
    assert merged[2].hotel_name == "C"
    existing_r = r1.select(*store.REVIEW_COLUMNS, ts1.alias("created_at"), ts1.alias("updated_at"))
    mr = {r.hotel_review_id: r.review_title for r in store.merge_reviews(existing_r, r2, ts2).collect()}
    assert mr == {1: "old", 2: None}
