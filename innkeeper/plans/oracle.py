"""DuckDB oracle SQL for the registered queries.

The SQL recomputes each expected result straight from the base tables, without
building or parsing JSON lines: it states the outcome of parse/flatten/validate/store
for each bridge twist (see sources/bridge.py for the fixed values it repeats).
"""

from __future__ import annotations

# Review feed: one record per lineitem row (+ one blank line when l_orderkey % 53 = 0).
_REVIEW_CTE = """
src AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate, l_returnflag, l_linestatus,
         s_name, s_acctbal, p_name,
         'f' || CAST(l_orderkey % 4 AS VARCHAR) AS file,
         l_orderkey % 4 AS file_rank,
         CASE WHEN l_shipdate < TIMESTAMP '1998-06-01 00:00:00' THEN 1 ELSE 2 END AS load
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
),
rec AS (
  SELECT *,
    l_orderkey % 97 <> 0 AS parsed,
    l_orderkey % 53 = 0 AS has_blank,
    l_orderkey % 59 = 0 AS has_falsy,
    (l_orderkey % 53 = 0)::INT + (l_orderkey % 59 = 0)::INT AS extra_lines,
    l_orderkey % 2 = 0 AS nested,
    CASE WHEN l_orderkey % 79 = 0 THEN 'absent' WHEN l_orderkey % 83 = 0 THEN 'null'
         WHEN l_orderkey % 67 = 0 THEN 'str' ELSE 'num' END AS rating_kind,
    (l_quantity - 3) / 4.0 AS rating_num,
    CASE l_linenumber % 5 WHEN 0 THEN 'agoda' WHEN 1 THEN 'booking' WHEN 2 THEN 'expedia'
         WHEN 3 THEN '  ' ELSE 'tripadvisor' END AS platform,
    CASE WHEN l_orderkey % 89 = 0 THEN 0 ELSE l_orderkey * 8 + l_linenumber END AS review_id,
    'job-' || md5('f' || CAST(l_orderkey % 4 AS VARCHAR) || '-agoda') AS job_id
  FROM src
),
chk AS (
  SELECT *,
    (rating_kind = 'num' AND (rating_num < 0 OR rating_num > 10)) AS e_rating,
    (l_suppkey = 0 AND l_orderkey % 12 <> 5) AS e_hotel,
    (l_linenumber % 5 = 3) AS e_platform,
    nested AND rating_kind <> 'absent' AS raw
  FROM rec
),
val AS (
  SELECT *, parsed AND NOT (e_rating OR e_hotel OR e_platform) AS is_valid FROM chk
),
txt AS (
  SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
    CASE WHEN l_partkey % 101 = 0 THEN repeat('x', 501) ELSE p_name END AS review_title,
    l_returnflag || '-' || l_linestatus AS rating_text,
    CASE WHEN l_orderkey % 5 <> 0 THEN 'c' || l_partkey END AS review_comments,
    CASE WHEN l_linenumber % 3 <> 0 THEN 'p' || l_suppkey END AS review_positives,
    CASE WHEN l_orderkey % 4 = 1 THEN l_suppkey::VARCHAR ELSE 'n' || l_linenumber END AS review_negatives,
    strftime(l_shipdate, '%Y-%m') AS check_in_date_month_and_year,
    CASE WHEN l_orderkey % 11 = 0 THEN 'true' ELSE 'r' || l_suppkey END AS responder_name,
    'd' || l_linenumber AS response_date_text, 'en' AS translate_source,
    CASE WHEN l_orderkey % 103 = 0 THEN repeat('x', 11) ELSE 'de' END AS translate_target,
    'e' || l_orderkey AS encrypted_review_data, 'P' || (l_partkey % 5) AS review_provider_text,
    l_orderkey % 5 < 2 AS is_show_review_response,
    CASE l_orderkey % 8 WHEN 0 THEN l_partkey % 1000 WHEN 1 THEN 12 WHEN 3 THEN 5 WHEN 5 THEN 0 WHEN 6 THEN 77
         WHEN 7 THEN 1 END::INTEGER AS provider_id,
    CASE l_orderkey % 8 WHEN 0 THEN (l_partkey % 1000)::VARCHAR WHEN 1 THEN '" 12 "' WHEN 2 THEN 'null' WHEN 3 THEN '[5]'
         WHEN 5 THEN '""' WHEN 6 THEN CASE WHEN l_orderkey % 61 = 0 THEN '"abc"' ELSE '77' END WHEN 7 THEN 'true' END AS provider_json,
    CASE l_orderkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN '"false"' WHEN 2 THEN 'false' WHEN 3 THEN '0' END AS shown_json,
    CASE WHEN l_orderkey % 10 < 3 THEN 'M' || l_partkey END AS reviewer_name,
    CASE WHEN l_orderkey % 73 = 0 THEN NULL WHEN l_orderkey % 71 = 0 THEN 'not a date' WHEN l_orderkey % 113 = 0 THEN '12:30'
         ELSE CASE l_orderkey % 6 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
              WHEN 1 THEN strftime(l_shipdate, '%-m/%-d/%Y') WHEN 2 THEN strftime(l_shipdate, '%b %-d, %Y')
              WHEN 3 THEN strftime(l_shipdate, '%-d %B %Y') WHEN 4 THEN strftime(l_shipdate, '%a, %d %b %Y %H:%M:%S GMT')
              ELSE strftime(l_shipdate, '%Y-%m-%d') END END AS date_text
  FROM src
),
elig AS (
  SELECT *, is_valid AND review_id <> 0 AND rating_kind <> 'absent' AS eligible FROM val
),
rrows AS (
  SELECT *,
    CAST(CAST(rating_num AS VARCHAR) AS DECIMAL(3,1)) AS rating_dec,
    CASE WHEN l_orderkey % 73 = 0 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE l_shipdate END AS review_date,
    l_orderkey % 73 <> 0 AND (l_orderkey % 71 = 0 OR l_orderkey % 113 = 0) AS bad_date,
    l_orderkey % 8 = 6 AND l_orderkey % 61 = 0 AS bad_provider,
    l_partkey % 101 = 0 AS bad_title, l_orderkey % 103 = 0 AS bad_target,
    NOT (bad_date OR bad_provider OR bad_title OR bad_target) AS storable
  FROM elig JOIN txt USING (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate)
  WHERE eligible AND (rating_kind = 'str' OR (rating_kind = 'num' AND rating_num <> 0))
),
hrows AS (
  SELECT *,
    CASE WHEN l_suppkey % 7 = 0 THEN NULL
         ELSE CAST(CAST(s_acctbal / 1000 AS VARCHAR) AS DECIMAL(3,1)) END AS score_dec,
    CASE WHEN l_suppkey % 7 = 0 THEN 0 ELSE CAST(l_partkey % 50 AS INTEGER) END AS review_count,
    CASE WHEN l_suppkey % 7 = 0 THEN '{}' ELSE '{"clean":' || CAST(l_partkey % 10 AS VARCHAR) || '}' END AS grades
  FROM elig WHERE eligible AND l_suppkey % 10 <> 9
)"""

_ORD = "file_rank, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey"
_ORD_DESC = ", ".join(c + " DESC" for c in _ORD.split(", "))


def _with(body: str) -> str:
    return "WITH " + _REVIEW_CTE + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["ingest_file_counts"] = _with("""
SELECT file,
       CAST(COUNT(*) + SUM(extra_lines) AS BIGINT) AS total_records,
       CAST(SUM(CASE WHEN is_valid THEN 1 ELSE 0 END) AS BIGINT) AS valid_records,
       CAST(SUM(CASE WHEN is_valid THEN 0 ELSE 1 END) + COUNT(*) FILTER (has_falsy) AS BIGINT) AS invalid_records
FROM val GROUP BY file""")

ORACLE["valid_records"] = _with("""
SELECT file, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_suppkey AS hotel_id, platform,
       CASE WHEN nested AND NOT raw THEN NULL ELSE review_id END AS hotel_review_id,
       CASE WHEN rating_kind = 'num' THEN rating_num END AS rating,
       raw
FROM val WHERE is_valid""")

def _collected(valid: str, falsy_valid: bool) -> str:
    """Counters with records collected; falsy lines are parsed but never collected."""
    ok, bad = ("+ COUNT(*) FILTER (has_falsy)", "") if falsy_valid else ("", "+ COUNT(*) FILTER (has_falsy)")
    return _with(f"""
SELECT file, CAST(COUNT(*) + SUM(extra_lines) AS BIGINT) AS total_records,
       CAST(COUNT(*) FILTER ({valid}) {ok} AS BIGINT) AS valid_records,
       CAST(COUNT(*) FILTER (NOT ({valid})) {bad} AS BIGINT) AS invalid_records,
       CAST(COUNT(*) FILTER ({valid}) AS BIGINT) AS collected_records
FROM val GROUP BY file""")


ORACLE["valid_no_rules"] = _collected("parsed", True)
ORACLE["strict_no_rules"] = _collected("parsed", True)
ORACLE["custom_rules"] = _collected("parsed AND NOT (nested AND NOT raw)", False)

ORACLE["rejects"] = _with(f"""
, lines AS (
  SELECT file, {_ORD}, 0 AS sub, is_valid,
         CASE WHEN NOT parsed THEN 'Invalid JSON format'
              ELSE concat_ws(', ',
                CASE WHEN e_rating THEN 'Rating must be between 0 and 10' END,
                CASE WHEN e_hotel THEN 'Hotel ID is required' END,
                CASE WHEN e_platform THEN 'Platform is required' END) END AS errors
  FROM val
  UNION ALL
  SELECT file, {_ORD}, 1 AS sub, NULL AS is_valid, NULL AS errors FROM val WHERE has_blank
  UNION ALL
  SELECT file, {_ORD}, 2 AS sub, false AS is_valid,
         CASE WHEN l_orderkey % 4 = 0 THEN 'Cannot read properties of null (reading ''rating'')'
              ELSE 'Hotel ID is required, Platform is required' END AS errors FROM val WHERE has_falsy
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY {_ORD}, sub) AS line_no FROM lines
)
SELECT file, line_no, errors FROM numbered WHERE is_valid = false""")

_TEXTS = ["rating_text", "review_title", "review_comments", "review_positives", "review_negatives",
          "check_in_date_month_and_year", "responder_name", "response_date_text", "translate_source", "translate_target",
          "encrypted_review_data", "review_provider_text"]
_FLAT = [*_TEXTS, "provider_json", "shown_json", "reviewer_name"]
_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
ORACLE["flattened_reviews"] = _with(f"""
SELECT file, {_KEYS}, raw,
       CASE WHEN nested AND NOT raw THEN NULL ELSE review_id END AS hotel_review_id,
       CASE WHEN rating_kind = 'num' THEN rating_num END AS rating,
       {", ".join(f"CASE WHEN NOT (nested AND NOT raw) THEN {c} END AS {c}" for c in _FLAT)},
       CASE WHEN NOT (nested AND NOT raw) THEN date_text END AS review_date,
       CASE WHEN l_suppkey % 10 = 9 THEN NULL ELSE s_name END AS hotel_name
FROM val JOIN txt USING (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate) WHERE parsed
UNION ALL
SELECT file, {_KEYS}, false, NULL, NULL, {", ".join("NULL" for _ in _FLAT)}, NULL, NULL FROM val WHERE has_falsy""")

ORACLE["strict_policy_counts"] = _with("""
SELECT file,
       CAST(COUNT(*) + SUM(extra_lines) AS BIGINT) AS total_records,
       CAST(SUM(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS valid_records,
       CAST(SUM(CASE WHEN ok THEN 0 ELSE 1 END) + COUNT(*) FILTER (has_falsy) AS BIGINT) AS invalid_records,
       CAST(SUM(CASE WHEN parsed AND NOT nested THEN 1 ELSE 0 END) + COUNT(*) FILTER (has_falsy) AS BIGINT) AS transform_errors
FROM (
  SELECT *, parsed AND nested
            AND NOT ((rating_kind = 'num' AND (rating_num < 0 OR rating_num > 10)) OR e_hotel OR e_platform) AS ok
  FROM chk) GROUP BY file""")

_REVIEW_SELECT = f"""
SELECT CAST(review_id AS INTEGER) AS hotel_review_id, CAST(l_suppkey AS INTEGER) AS hotel_id,
       CAST(NULL AS INTEGER) AS reviewer_id, platform, CAST(rating_dec AS DOUBLE) AS rating, {", ".join(_TEXTS)},
       review_date, is_show_review_response, provider_id, job_id AS processing_job_id"""

ORACLE["reviews_insert"] = _with(f"""
, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY {_ORD}) AS rn
  FROM rrows WHERE storable
)
{_REVIEW_SELECT}
FROM firsts WHERE rn = 1""")

ORACLE["reviews_merge"] = _with(f"""
, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY load, {_ORD}) AS rn
  FROM rrows WHERE storable
)
{_REVIEW_SELECT}
FROM firsts WHERE rn = 1""")

_HOTEL_SELECT = """
SELECT CAST(l_suppkey AS INTEGER) AS hotel_id, first_platform AS platform, s_name AS hotel_name,
       CAST(score_dec AS DOUBLE) AS overall_score, review_count, grades"""

def _hotels(order_asc: str, order_desc: str) -> str:
    return _with(f"""
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {order_desc}) AS rn_last,
            row_number() OVER (PARTITION BY l_suppkey ORDER BY {order_asc}) AS rn_first
  FROM hrows
), firsts AS (
  SELECT l_suppkey AS k, platform AS first_platform FROM ranked WHERE rn_first = 1
)
{_HOTEL_SELECT}
FROM ranked JOIN firsts ON l_suppkey = k WHERE rn_last = 1""")


ORACLE["hotels_upsert"] = _hotels(_ORD, _ORD_DESC)
ORACLE["hotels_merge"] = _hotels("load, " + _ORD, "load DESC, " + _ORD_DESC)

ORACLE["store_counters"] = _with(f"""
, firsts AS (
  SELECT review_id FROM rrows WHERE storable GROUP BY review_id
)
SELECT 'store_valid' AS metric, CAST(COUNT(*) FILTER (WHERE eligible) AS BIGINT) AS value FROM elig WHERE is_valid
UNION ALL SELECT 'store_invalid', CAST(COUNT(*) FILTER (WHERE NOT eligible) AS BIGINT) FROM elig WHERE is_valid
UNION ALL SELECT 'hotel_rows', CAST(COUNT(*) AS BIGINT) FROM hrows
UNION ALL SELECT 'hotels_upserted', CAST(COUNT(*) AS BIGINT) FROM hrows
UNION ALL SELECT 'review_rows', CAST(COUNT(*) AS BIGINT) FROM rrows
UNION ALL SELECT 'reviews_rejected', CAST(COUNT(*) FILTER (WHERE NOT storable) AS BIGINT) FROM rrows
UNION ALL SELECT 'reviews_inserted', CAST(COUNT(*) AS BIGINT) FROM firsts""")


# ---------------------------------------------------------------------------
# Stored tables of one load, job ledger from orders
# ---------------------------------------------------------------------------
_TABLES_CTE = f"""
, rfirst AS (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY {_ORD}) AS rn FROM rrows WHERE storable
), reviews_t AS (
  SELECT CAST(review_id AS INTEGER) AS hotel_review_id, CAST(l_suppkey AS INTEGER) AS hotel_id, platform,
         CAST(rating_dec AS DOUBLE) AS rating, review_date, is_show_review_response,
         job_id AS processing_job_id, reviewer_name, l_suppkey, l_linenumber
  FROM rfirst WHERE rn = 1
), hranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {_ORD_DESC}) AS rn_last,
            row_number() OVER (PARTITION BY l_suppkey ORDER BY {_ORD}) AS rn_first
  FROM hrows
), hotels_t AS (
  SELECT CAST(a.l_suppkey AS INTEGER) AS hotel_id, b.platform AS platform, a.s_name AS hotel_name,
         CAST(a.score_dec AS DOUBLE) AS overall_score, a.review_count
  FROM hranked a JOIN hranked b ON a.l_suppkey = b.l_suppkey AND b.rn_first = 1
  WHERE a.rn_last = 1
), counts AS (
  SELECT file, CAST(COUNT(*) + SUM(extra_lines) AS BIGINT) AS total_records,
         CAST(SUM(CASE WHEN is_valid THEN 1 ELSE 0 END) AS BIGINT) AS valid_records,
         CAST(SUM(CASE WHEN is_valid THEN 0 ELSE 1 END) + COUNT(*) FILTER (has_falsy) AS BIGINT) AS invalid_records
  FROM val GROUP BY file
), inserted AS (
  SELECT file, COUNT(*) AS n FROM rfirst WHERE rn = 1 GROUP BY file
), upserted AS (
  SELECT file, COUNT(*) AS n FROM hrows GROUP BY file
), run_ledger AS (
  SELECT 'job-' || md5(m.file || '-agoda') AS job_id, m.file AS filepath, 'agoda' AS platform,
         COALESCE(c.total_records, 0) AS total_records, COALESCE(c.valid_records, 0) AS valid_records,
         COALESCE(c.invalid_records, 0) AS invalid_records, COALESCE(u.n, 0) AS hotels_upserted,
         COALESCE(i.n, 0) AS reviews_inserted
  FROM (SELECT 'f' || CAST(range AS VARCHAR) AS file FROM range(5)) m LEFT JOIN counts c ON m.file = c.file
       LEFT JOIN inserted i ON m.file = i.file LEFT JOIN upserted u ON m.file = u.file
)"""


def _tables(body: str) -> str:
    return _with(_TABLES_CTE + "\n" + body)


_PLATFORM_OF_PRIORITY = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'agoda' WHEN '2' THEN 'booking'
         WHEN '3' THEN 'expedia' WHEN '4' THEN 'hotels' WHEN '5' THEN 'tripadvisor' END"""

_JOBS_CTE = f"""WITH jobs0 AS (
  SELECT o_orderkey, o_totalprice, o_orderdate,
         'orders/' || CAST(o_orderkey AS VARCHAR) || '.jl' AS filepath,
         {_PLATFORM_OF_PRIORITY} AS platform,
         CASE WHEN o_orderkey % 3 = 0 THEN 's3' ELSE 'local' END AS storage_provider,
         CASE WHEN o_orderkey % 10 = 0 THEN 'pending' WHEN o_orderstatus = 'F' THEN 'completed'
              WHEN o_orderstatus = 'P' THEN 'processing' WHEN o_orderstatus = 'O' THEN 'failed'
              ELSE 'pending' END AS status
  FROM orders
), jobs1 AS (
  SELECT *, 'job-' || md5(filepath || '-' || platform) AS job_id, status IN ('completed', 'failed') AS done,
         CAST(o_orderkey % 1000 AS INTEGER) AS tot, CAST((o_orderkey % 1000) % 7 AS INTEGER) AS inv
  FROM jobs0
), ledger AS (
  SELECT o_orderkey, job_id, filepath, platform, storage_provider, status,
         CASE WHEN done THEN tot ELSE 0 END AS total_records,
         CASE WHEN done THEN tot - inv ELSE 0 END AS valid_records,
         CASE WHEN done THEN inv ELSE 0 END AS invalid_records,
         CASE WHEN done THEN CAST(o_orderkey % 50 AS INTEGER) ELSE 0 END AS hotels_upserted,
         CASE WHEN done THEN CAST(o_orderkey % 700 AS INTEGER) ELSE 0 END AS reviews_inserted,
         CASE WHEN done THEN CAST(floor(o_totalprice) % 5000 AS INTEGER) ELSE 0 END AS processing_time_ms,
         CASE WHEN status = 'failed' THEN 'File processing failed: order ' || CAST(o_orderkey AS VARCHAR)
              ELSE '' END AS errors,
         o_orderdate AS created_at, o_orderdate AS updated_at,
         CASE WHEN status <> 'pending' THEN o_orderdate END AS started_at,
         CASE WHEN done THEN o_orderdate END AS completed_at
  FROM jobs1
)"""

ORACLE["file_admission"] = f"""
WITH req AS (
  SELECT 'orders/' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 17 = 0 THEN '.json' ELSE '.jl' END AS filepath,
         CASE WHEN o_orderkey % 19 = 0 THEN 'unknown' WHEN o_orderkey % 31 = 0 THEN '  ' ELSE {_PLATFORM_OF_PRIORITY} END AS platform,
         CASE WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN 'gcs'
              WHEN o_orderkey % 3 = 0 THEN 's3' ELSE 'local' END AS storage_provider,
         o_orderkey % 11 <> 0 AS present, (o_orderkey % 13) * 100 AS len
  FROM orders
), d AS (
  SELECT *, CASE
      WHEN trim(platform) = '' OR storage_provider = '' THEN 'Missing required fields: filepath, platform, storageProvider'
      WHEN platform NOT IN ('agoda', 'booking', 'expedia', 'hotels', 'tripadvisor') THEN 'Invalid platform'
      WHEN storage_provider = 'gcs' THEN 'Storage provider not supported'
      WHEN storage_provider = 'local' AND NOT present THEN 'File is not valid'
      WHEN storage_provider = 's3' AND NOT (present AND len > 0 AND filepath LIKE '%.jl') THEN 'File is not valid'
    END AS err
  FROM req
)
SELECT filepath, platform, storage_provider, err IS NULL AS admitted, err AS error FROM d"""

_COUNTS = "total_records, valid_records, invalid_records, hotels_upserted, reviews_inserted"
ORACLE["multi_file_results"] = _tables("""
SELECT filepath AS file, 'agoda' AS platform, 'local' AS storage_provider, 'completed' AS status, true AS success,
       CAST(total_records AS INTEGER) AS total_records, CAST(valid_records AS INTEGER) AS valid_records,
       CAST(invalid_records AS INTEGER) AS invalid_records, CAST(hotels_upserted AS INTEGER) AS hotels_upserted,
       CAST(reviews_inserted AS INTEGER) AS reviews_inserted, '' AS errors, true AS started, true AS ended
FROM run_ledger WHERE filepath <> 'f4'
UNION ALL SELECT 'empty.jl', 'agoda', 'local', 'completed', true, 0, 0, 0, 0, 0, '', true, true
UNION ALL SELECT 'missing.jl', 'agoda', 'local', 'failed', false, 0, 0, 0, 0, 0,
                 'File processing failed: File is not valid', true, true""")

ORACLE["request_identity"] = _tables("""
, one AS (SELECT filepath AS file, total_records, valid_records, invalid_records FROM run_ledger),
total AS (SELECT SUM(total_records) AS t, SUM(valid_records) AS v, SUM(invalid_records) AS i FROM one)
SELECT file, 'agoda' AS platform, 'completed' AS status, total_records, valid_records, invalid_records FROM one WHERE file = 'f0'
UNION ALL SELECT file, 'booking', 'completed', total_records, valid_records, invalid_records FROM one WHERE file = 'f0'
UNION ALL SELECT file, 'agoda', 'already_processed', total_records, valid_records, invalid_records FROM one WHERE file = 'f0'
UNION ALL SELECT file, 'expedia', 'completed', total_records, valid_records, invalid_records FROM one WHERE file = 'f1'
UNION ALL SELECT 'feed', 'agoda', 'completed', CAST(t AS BIGINT), CAST(v AS BIGINT), CAST(i AS BIGINT) FROM total
UNION ALL SELECT file, 'agoda', 'completed', total_records, valid_records, invalid_records FROM one WHERE file = 'f2'""")

ORACLE["shared_store"] = _tables("""
SELECT (SELECT COUNT(*) FROM reviews_t) AS reviews, (SELECT COUNT(DISTINCT hotel_id) FROM reviews_t) AS hotels_reviewed,
       CAST(4 AS BIGINT) AS completed_jobs, CAST((SELECT COUNT(*) FROM reviews_t) AS BIGINT) AS reviews_inserted,
       CAST(SUM(total_records) AS BIGINT) AS total_records FROM run_ledger""")

ORACLE["job_by_id"] = _JOBS_CTE + """
SELECT job_id, filepath, platform, status, status = 'completed' AS is_completed FROM ledger WHERE filepath = 'orders/7.jl'"""

ORACLE["job_ids"] = _JOBS_CTE + "\nSELECT filepath, platform, job_id FROM ledger"

ORACLE["ingest_gate"] = _JOBS_CTE + """
SELECT r.job_id,
       CASE WHEN s.job_id IS NULL THEN 'create' WHEN s.status = 'completed' THEN 'skip'
            WHEN s.status = 'processing' THEN 'reject' ELSE 'rerun' END AS action,
       CASE WHEN s.status = 'completed' THEN 'already_processed' WHEN s.status = 'processing' THEN 'failed'
            ELSE 'completed' END AS result_status,
       CASE WHEN s.status = 'processing' THEN 'File is currently being processed' END AS error,
       CASE WHEN s.status = 'completed' THEN COALESCE(s.total_records, 0) ELSE 0 END AS total_records,
       CASE WHEN s.status = 'completed' THEN COALESCE(s.valid_records, 0) ELSE 0 END AS valid_records,
       CASE WHEN s.status = 'completed' THEN COALESCE(s.invalid_records, 0) ELSE 0 END AS invalid_records,
       CASE WHEN s.status = 'completed' THEN COALESCE(s.hotels_upserted, 0) ELSE 0 END AS hotels_upserted,
       CASE WHEN s.status = 'completed' THEN COALESCE(s.reviews_inserted, 0) ELSE 0 END AS reviews_inserted
FROM ledger r LEFT JOIN (SELECT * FROM ledger WHERE o_orderkey % 4 <> 0) s ON r.job_id = s.job_id"""

_NOW = "TIMESTAMP '2025-06-01 00:00:00'"
ORACLE["ledger_transition"] = _JOBS_CTE + f"""
, upd AS (
  SELECT job_id AS uid,
         CASE WHEN o_orderkey % 9 = 0 THEN 'completed' WHEN o_orderkey % 9 = 3 THEN 'failed' ELSE 'processing' END AS u_status,
         CASE WHEN o_orderkey % 9 <> 3 THEN CAST(o_orderkey % 500 AS INTEGER) END AS u_total,
         CASE WHEN o_orderkey % 9 <> 3 THEN CAST(o_orderkey % 500 - o_orderkey % 5 AS INTEGER) END AS u_valid,
         CASE WHEN o_orderkey % 9 <> 3 THEN CAST(o_orderkey % 5 AS INTEGER) END AS u_invalid,
         CASE WHEN o_orderkey % 9 <> 3 THEN CAST(o_orderkey % 40 AS INTEGER) END AS u_hotels,
         CASE WHEN o_orderkey % 9 <> 3 THEN CAST(o_orderkey % 600 AS INTEGER) END AS u_reviews,
         CASE WHEN o_orderkey % 9 <> 3 THEN CAST(o_orderkey % 777 AS INTEGER) END AS u_ms,
         CASE WHEN o_orderkey % 9 = 3 THEN 'retry failed' END AS u_errors
  FROM ledger WHERE o_orderkey % 3 = 0
), j AS (
  SELECT *, u_status IN ('completed', 'failed') AS closing FROM ledger LEFT JOIN upd ON job_id = uid
)
SELECT job_id, COALESCE(u_status, status) AS status,
       CASE WHEN closing THEN COALESCE(u_total, total_records) ELSE total_records END AS total_records,
       CASE WHEN closing THEN COALESCE(u_valid, valid_records) ELSE valid_records END AS valid_records,
       CASE WHEN closing THEN COALESCE(u_invalid, invalid_records) ELSE invalid_records END AS invalid_records,
       CASE WHEN closing THEN COALESCE(u_hotels, hotels_upserted) ELSE hotels_upserted END AS hotels_upserted,
       CASE WHEN closing THEN COALESCE(u_reviews, reviews_inserted) ELSE reviews_inserted END AS reviews_inserted,
       CASE WHEN closing THEN COALESCE(u_ms, processing_time_ms) ELSE processing_time_ms END AS processing_time_ms,
       CASE WHEN closing THEN COALESCE(u_errors, errors) ELSE errors END AS errors,
       CASE WHEN u_status = 'processing' THEN {_NOW} ELSE started_at END AS started_at,
       CASE WHEN closing THEN {_NOW} ELSE completed_at END AS completed_at,
       CASE WHEN uid IS NOT NULL THEN {_NOW} ELSE updated_at END AS updated_at
FROM j"""

ORACLE["job_status"] = _JOBS_CTE + """
SELECT job_id, status, total_records, valid_records, invalid_records, processing_time_ms,
       CAST(round(total_records / NULLIF(processing_time_ms, 0) * 1000) AS BIGINT) AS records_per_sec
FROM ledger"""

ORACLE["run_summary"] = _JOBS_CTE + """
SELECT platform, status, COUNT(*) AS jobs,
       CAST(SUM(total_records) AS BIGINT) AS total_records, CAST(SUM(valid_records) AS BIGINT) AS valid_records,
       CAST(SUM(invalid_records) AS BIGINT) AS invalid_records,
       CAST(SUM(hotels_upserted) AS BIGINT) AS hotels_upserted, CAST(SUM(reviews_inserted) AS BIGINT) AS reviews_inserted,
       CAST(SUM(processing_time_ms) AS BIGINT) AS processing_time_ms
FROM ledger GROUP BY platform, status"""

ORACLE["jobs_by_status"] = _JOBS_CTE + """
SELECT job_id, filepath, platform, status, created_at FROM ledger WHERE status = 'completed'
ORDER BY created_at DESC NULLS FIRST, job_id ASC NULLS LAST LIMIT 10"""

ORACLE["jobs_page"] = _JOBS_CTE + """
SELECT job_id, status, created_at, (SELECT COUNT(*) FROM ledger) AS total, 10 AS page_limit,
       20 AS page_offset, 3 AS page, CAST(ceil((SELECT COUNT(*) FROM ledger) / 10) AS BIGINT) AS total_pages
FROM (SELECT * FROM ledger ORDER BY created_at DESC NULLS FIRST, job_id ASC NULLS LAST LIMIT 10 OFFSET 20)"""

_RCOLS = "hotel_review_id, hotel_id, platform, rating, review_date, processing_job_id"
_HCOLS = "hotel_id, platform, hotel_name, overall_score, review_count"

ORACLE["point_lookup"] = _tables(f"SELECT {_HCOLS} FROM hotels_t WHERE hotel_id = 1")
ORACLE["review_lookup"] = _tables(f"SELECT {_RCOLS} FROM reviews_t WHERE hotel_review_id = 15")
ORACLE["newest_reviews_by_hotel"] = _tables(f"""SELECT {_RCOLS} FROM reviews_t WHERE hotel_id = 1
ORDER BY review_date DESC NULLS FIRST, hotel_review_id ASC NULLS LAST LIMIT 50""")
ORACLE["newest_reviews_by_platform"] = _tables(f"""SELECT {_RCOLS} FROM reviews_t WHERE platform = 'agoda'
ORDER BY review_date DESC NULLS FIRST, hotel_review_id ASC NULLS LAST LIMIT 50""")
ORACLE["hotels_by_review_count"] = _tables(f"""SELECT {_HCOLS} FROM hotels_t WHERE platform = 'agoda'
ORDER BY review_count DESC NULLS FIRST, hotel_id ASC NULLS LAST LIMIT 50""")
ORACLE["generic_page"] = _tables(f"""SELECT {_HCOLS}, (SELECT COUNT(*) FROM hotels_t) AS total, 10 AS page_limit,
       10 AS page_offset, 2 AS page, CAST(ceil((SELECT COUNT(*) FROM hotels_t) / 10) AS BIGINT) AS total_pages
FROM (SELECT * FROM hotels_t ORDER BY overall_score DESC NULLS FIRST, hotel_id ASC NULLS LAST LIMIT 10 OFFSET 10)""")
ORACLE["table_counts"] = _tables("""SELECT 'hotels' AS table_name, COUNT(*) AS rows FROM hotels_t
UNION ALL SELECT 'reviews', COUNT(*) FROM reviews_t
UNION ALL SELECT 'processing_jobs', COUNT(*) FROM orders""")
ORACLE["review_filters"] = _tables(f"""SELECT {_RCOLS} FROM reviews_t
WHERE platform = 'booking' AND rating BETWEEN 2 AND 8
  AND review_date BETWEEN TIMESTAMP '1994-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00'
  AND is_show_review_response""")
ORACLE["hotel_filters"] = _tables(f"""SELECT {_HCOLS} FROM hotels_t
WHERE platform = 'agoda' AND overall_score BETWEEN 1 AND 9 AND review_count BETWEEN 5 AND 40""")
ORACLE["reviews_with_hotel"] = _tables("""SELECT r.hotel_review_id, r.hotel_id, r.rating, h.hotel_name, h.overall_score
FROM reviews_t r LEFT JOIN hotels_t h ON r.hotel_id = h.hotel_id""")
ORACLE["reviews_with_job"] = _tables("""SELECT r.hotel_review_id, r.processing_job_id, l.filepath,
       l.total_records, l.reviews_inserted
FROM reviews_t r LEFT JOIN run_ledger l ON r.processing_job_id = l.job_id""")
ORACLE["reviews_with_reviewer"] = _tables("""
SELECT hotel_review_id, hotel_id, reviewer_name AS displayMemberName, 'C' || (l_suppkey % 5) AS countryName,
       l_suppkey % 5 AS countryId, CAST(l_linenumber AS BIGINT) AS reviewerReviewedCount, l_linenumber > 3 AS isExpertReviewer
FROM reviews_t WHERE reviewer_name IS NOT NULL""")
ORACLE["reviewers_dim"] = """
WITH cnt AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey)
SELECT c_custkey AS reviewer_id, c_name AS display_member_name, n_name AS country_name,
       c_nationkey AS country_id, CAST(COALESCE(n, 0) AS INTEGER) AS reviewer_reviewed_count,
       COALESCE(n, 0) > 10 AS is_expert_reviewer
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN cnt ON c_custkey = o_custkey"""

ORACLE["schema_report"] = """
SELECT event_id, event_id % 13 <> 0 AS ok,
       CASE WHEN event_id % 13 = 0 THEN 'Invalid JSON format' ELSE '' END AS problems
FROM events"""
# The streaming ingest must store exactly what the batch ingest stores.
ORACLE["stream_ingest"] = ORACLE["reviews_insert"]
ORACLE["stream_resume"] = ORACLE["hotels_upsert"]

ORACLE["file_runs"] = _tables(f"""
SELECT r.run, filepath AS file, CASE WHEN r.run = 1 THEN 'completed' ELSE 'already_processed' END AS status,
       {_COUNTS}, CAST(NULL AS VARCHAR) AS error
FROM run_ledger JOIN (SELECT 1 AS run UNION ALL SELECT 2) r ON filepath <> 'f4'
UNION ALL SELECT 1, 'empty.jl', 'completed', 0, 0, 0, 0, 0, NULL
UNION ALL SELECT 2, 'empty.jl', 'already_processed', 0, 0, 0, 0, 0, NULL
UNION ALL SELECT 1, 'missing.jl', 'failed', 0, 0, 0, 0, 0, 'File is not valid'
UNION ALL SELECT 2, 'missing.jl', 'failed', 0, 0, 0, 0, 0, 'File is not valid'""")

# Rejected lines of the feed files, and of the valid ones those that the tables cannot hold.
ORACLE["run_rejects"] = ORACLE["rejects"].replace("SELECT file, line_no, errors FROM numbered", """, bad_rows AS (
  SELECT n.file, n.line_no, concat_ws(', ', CASE WHEN bad_date THEN 'review_date: invalid date' END,
         CASE WHEN bad_provider THEN 'provider_id: not an integer' END,
         CASE WHEN bad_title THEN 'review_title: longer than 500' END,
         CASE WHEN bad_target THEN 'translate_target: longer than 10' END) AS errors
  FROM rrows r JOIN numbered n ON n.sub = 0 AND n.l_orderkey = r.l_orderkey AND n.l_linenumber = r.l_linenumber
       AND n.l_partkey = r.l_partkey AND n.l_suppkey = r.l_suppkey AND n.l_shipdate = r.l_shipdate
  WHERE NOT r.storable)
SELECT file, line_no, 'review' AS stage, errors FROM bad_rows
UNION ALL SELECT file, line_no, 'record', errors FROM numbered""")

# ---------------------------------------------------------------------------
# Failing, resumed, mixed and single-row runs
# ---------------------------------------------------------------------------
_INT_COUNTS = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in _COUNTS.split(", "))
ORACLE["crash_recovery"] = _tables(f"""
SELECT filepath AS file, 'completed' AS run_1, 'already_processed' AS run_2, true AS taken_over, 'completed' AS status, {_INT_COUNTS},
       (SELECT COUNT(*) FROM reviews_t) AS stored_reviews
FROM run_ledger WHERE filepath <> 'f4'""")

# Which files' reviews are inserted depends on the order in which the stream meets equal keys; the feed has none
# in two files (a review id holds its order key), so the counts by file are those of a batch run.
ORACLE["stream_recovery"] = _tables(f"""
SELECT filepath AS file, 'completed' AS status, {_INT_COUNTS}, CAST(1 AS BIGINT) AS failed_then, CAST(0 AS BIGINT) AS completed_then,
       CAST(1 AS BIGINT) AS jobs_with_errors
FROM run_ledger WHERE filepath <> 'f4'""")

ORACLE["stream_progress"] = _tables("""
SELECT true AS several_batches, CAST(SUM(total_records) AS BIGINT) AS total_records, CAST(SUM(valid_records) AS BIGINT) AS valid_records,
       CAST(SUM(invalid_records) AS BIGINT) AS invalid_records, CAST(SUM(hotels_upserted) AS BIGINT) AS hotels_upserted,
       CAST(SUM(reviews_inserted) AS BIGINT) AS reviews_inserted
FROM run_ledger""")

ORACLE["folder_run"] = _tables("""
SELECT true AS all_successful, CAST(0 AS BIGINT) AS failed_files, CAST(SUM(total_records) AS BIGINT) AS total_records,
       CAST(SUM(valid_records) AS BIGINT) AS valid_records, CAST(SUM(invalid_records) AS BIGINT) AS invalid_records,
       CAST(SUM(hotels_upserted) AS BIGINT) AS hotels_upserted, CAST(SUM(reviews_inserted) AS BIGINT) AS reviews_inserted
FROM run_ledger""")

# A CR behind the "{" makes two invalid lines of a local record and changes nothing in the object store.
ORACLE["mixed_providers"] = _with("""
, marked AS (
  SELECT *, l_linenumber % 3 = 1 AS cr, parsed AND nested
         AND NOT ((rating_kind = 'num' AND (rating_num < 0 OR rating_num > 10)) OR e_hotel OR e_platform) AS strict_ok FROM val
), counted AS (
  SELECT file, COUNT(*) + SUM(extra_lines) AS lines, COUNT(*) FILTER (cr) AS crs, COUNT(*) FILTER (has_falsy) AS falsy,
         COUNT(*) FILTER (strict_ok) AS strict_valid, COUNT(*) FILTER (is_valid AND NOT cr) AS plain_valid, COUNT(*) AS recs
  FROM marked GROUP BY file
)
SELECT file || '.jl' AS file, 'agoda' AS platform, 'completed' AS status, CAST(lines AS BIGINT) AS total_records,
       CAST(strict_valid AS BIGINT) AS valid_records, CAST(recs - strict_valid + falsy AS BIGINT) AS invalid_records,
       CAST(NULL AS VARCHAR) AS error FROM counted WHERE file IN ('f0', 'f3')
UNION ALL SELECT file || '.jl', 'agoda', 'completed', CAST(lines + crs AS BIGINT), CAST(plain_valid AS BIGINT),
       CAST(recs + crs - plain_valid + falsy AS BIGINT), NULL FROM counted WHERE file IN ('f1', 'f2')
UNION ALL SELECT 'f0.jl', 'booking', 'failed', 0, 0, 0, 'Storage provider not supported'
UNION ALL SELECT 'f1.jl', '', 'failed', 0, 0, 0, 'Missing required fields: filepath, platform, storageProvider'
UNION ALL SELECT 'f2.txt', 'agoda', 'failed', 0, 0, 0, 'File is not valid'""")

ORACLE["hotel_grades"] = _tables("""
SELECT CAST(l_suppkey AS INTEGER) AS hotel_id, CASE WHEN l_suppkey % 7 = 0 THEN 0 ELSE 1 END AS n_grades,
       CASE WHEN l_suppkey % 7 <> 0 THEN 'clean' END AS grade, CASE WHEN l_suppkey % 7 <> 0 THEN CAST(l_partkey % 10 AS DOUBLE) END AS score
FROM hranked WHERE rn_last = 1""")

_LOADED_AT, _WRITTEN_AT = "TIMESTAMP '2025-01-01 00:00:00'", "TIMESTAMP '2025-02-01 00:00:00'"
ORACLE["hotel_writes"] = _tables(f"""
SELECT hotel_id, platform, CASE WHEN hotel_id = 1 THEN 'Renamed' ELSE hotel_name END AS hotel_name, overall_score, review_count,
       {_LOADED_AT} AS created_at, CASE WHEN hotel_id = 1 THEN {_WRITTEN_AT} ELSE {_LOADED_AT} END AS updated_at FROM hotels_t
UNION ALL SELECT 1000000000, 'booking', 'New', NULL, 0, {_WRITTEN_AT}, {_WRITTEN_AT}
UNION ALL SELECT 1, 'expedia', 'Renamed', NULL, 0, {_WRITTEN_AT}, {_WRITTEN_AT} WHERE NOT EXISTS (SELECT 1 FROM hotels_t WHERE hotel_id = 1)""")

ORACLE["review_writes"] = _tables(f"""
, counted AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (hotel_review_id = 15) AS there FROM reviews_t)
SELECT 1 AS call, hotel_review_id, hotel_id, r.platform, r.rating, CASE WHEN l_partkey % 101 = 0 THEN repeat('x', 501) ELSE p_name END AS review_title,
       {_LOADED_AT} AS created_at, {_LOADED_AT} AS updated_at, n + 2 - there AS reviews
FROM reviews_t r JOIN (SELECT review_id, l_partkey, p_name FROM rfirst WHERE rn = 1) f ON f.review_id = r.hotel_review_id, counted
WHERE hotel_review_id = 15
UNION ALL SELECT 1, 15, 1000000000, 'booking', NULL, 'first', {_WRITTEN_AT}, {_WRITTEN_AT}, n + 2 - there FROM counted WHERE there = 0
UNION ALL SELECT 2, 2000000000, 1000000000, 'booking', NULL, 'first', {_WRITTEN_AT}, {_WRITTEN_AT}, n + 2 - there FROM counted
UNION ALL SELECT 3, 2000000000, 1000000000, 'booking', NULL, 'first', {_WRITTEN_AT}, {_WRITTEN_AT}, n + 2 - there FROM counted""")
