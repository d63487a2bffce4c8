"""Trap lines of the service's parse / flatten / validate stage (lenient policy)."""

import json

import pytest
from pyspark.sql import functions as F

from innkeeper.operators import records, store
from innkeeper.sources.bridge import request_job_id

BASE = {"hotelId": 1, "platform": "a", "hotelReviewId": 1}


def rec(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is ...:
            d.pop(k, None)
        else:
            d[k] = v
    return json.dumps(d)


CASES = [
    # line, valid, reaches the review projection
    (rec(rating=0), True, False),
    (rec(rating=10), True, True),
    (rec(rating=10.1), False, False),
    (rec(rating=None), True, False),
    (rec(rating=...), True, False),
    (rec(rating="8.5abc"), True, True),
    (rec(rating=5, hotelId=0), False, False),
    (rec(rating=5, hotelId="0"), True, True),
    (rec(rating=5, platform="  "), False, False),
    (rec(rating=5, platform=" "), False, False),
    (rec(rating=5, platform=5), False, False),
    ("null", False, False),
    ("123", False, False),
    ("[]", False, False),
    ('"x"', False, False),
    ('{"hotelId":1} junk', False, False),
    ("1,2", False, False),
    ('{"a":01}', False, False),
    ("{'a':1}", False, False),
    ('{"a":NaN}', False, False),
    ('{"hotelId":0,"hotelId":2,"platform":"a","hotelReviewId":3,"rating":4}', True, True),
    ('{"hotelId":1,"platform":"a","comment":null}', False, False),
    ('{"hotelId":1,"platform":"a","comment":{"hotelReviewId":9}}', True, False),
    ('{"hotelId":1,"platform":"a","comment":{"hotelReviewId":9,"rating":11}}', False, False),
    ('{"hotelId":1,"platform":"a","comment":{"hotelReviewId":9,"rating":7}}', True, True),
    (rec(rating=5) + "\r", True, True),
]


def test_trap_lines(spark, lines_of):
    df = lines_of([c[0] for c in CASES])
    chk = records.check_lines(df)
    got = {r["i"]: r for r in chk.select(F.col("ord.i").alias("i"), "is_valid", "errors").collect()}
    rows = store.review_rows(chk.filter("is_valid"), request_job_id(F.col("file")))
    reached = {r["i"] for r in rows.select(F.col("ord.i").alias("i")).collect()}
    for i, (line, valid, projected) in enumerate(CASES):
        assert got[i]["is_valid"] == valid, (line, got[i]["errors"])
        assert (i in reached) == projected, line


def test_error_lists_in_rule_order(spark, lines_of):
    df = lines_of([rec(rating=11, hotelId=0, platform=""), rec(rating=5, platform=7), "null", "{"])
    errs = [r["errors"] for r in records.check_lines(df).orderBy("ord").select("errors").collect()]
    assert errs[0] == [records.MSG_RATING, records.MSG_HOTEL_ID, records.MSG_PLATFORM]
    assert errs[1] == [records.MSG_PLATFORM_TYPE]
    assert errs[2] == [records.MSG_NULL_RECORD]
    assert errs[3] == [records.MSG_PARSE]


def test_blank_lines_count_in_total_only(spark, lines_of):
    df = lines_of([rec(rating=1), "", "   ", " ﻿", rec(rating=2), rec(rating=3), rec(rating=4)])
    r = records.file_counts(records.check_lines(df)).collect()[0]
    assert (r.total_records, r.valid_records, r.invalid_records) == (7, 4, 0)


def test_validation_off(spark, lines_of):
    df = lines_of([rec(rating=50), "null", "{bad", '{"platform":"a","comment":null}'])
    r = records.file_counts(records.check_lines(df, validate=False)).collect()[0]
    assert (r.total_records, r.valid_records, r.invalid_records) == (4, 2, 2)


@pytest.mark.parametrize("policy,expected", [("lenient", 2), ("strict", 1)])
def test_policies(spark, lines_of, policy, expected):
    nested = '{"hotelId":1,"platform":"a","comment":{"hotelReviewId":9,"rating":7}}'
    flat = rec(rating=5)
    r = records.file_counts(records.check_lines(lines_of([nested, flat]), policy=policy)).collect()[0]
    assert r.valid_records == expected


def test_reviewer_projection(spark, lines_of):
    info = {"countryName": "Norway", "displayMemberName": "Kari", "countryId": 7, "isExpertReviewer": True,
            "lengthOfStay": "3"}
    nested = json.dumps({"hotelId": 1, "platform": "a",
                         "comment": {"hotelReviewId": 9, "rating": 7, "reviewerInfo": info}})
    out = records.reviewers(records.check_lines(lines_of([nested, rec(rating=5)]))).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.countryName, r.displayMemberName, r.countryId, r.isExpertReviewer, r.lengthOfStay) == \
        ("Norway", "Kari", 7, True, 3)
