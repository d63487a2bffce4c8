"""Registry of the queries exposed to the driver (name -> callable, name -> oracle SQL)."""

from __future__ import annotations

from . import ingest, recovery, service, streams
from .oracle import ORACLE

QUERIES = {
    "ingest_file_counts": ingest.ingest_file_counts,
    "valid_records": ingest.valid_records,
    "valid_no_rules": ingest.valid_no_rules,
    "rejects": ingest.rejects,
    "flattened_reviews": ingest.flattened_reviews,
    "strict_policy_counts": ingest.strict_policy_counts,
    "strict_no_rules": ingest.strict_no_rules,
    "custom_rules": ingest.custom_rules,
    "reviews_with_reviewer": service.reviews_with_reviewer,
    "reviews_insert": ingest.reviews_insert,
    "hotels_upsert": ingest.hotels_upsert,
    "hotels_merge": ingest.hotels_merge,
    "reviews_merge": ingest.reviews_merge,
    "store_counters": ingest.store_counters,
    "file_admission": service.file_admission,
    "multi_file_results": streams.multi_file_results,
    "request_identity": streams.request_identity,
    "run_rejects": streams.run_rejects,
    "shared_store": streams.shared_store,
    "job_by_id": service.job_by_id,
    "job_ids": service.job_ids,
    "ingest_gate": service.ingest_gate,
    "ledger_transition": service.ledger_transition,
    "job_status": service.job_status,
    "run_summary": service.run_summary,
    "jobs_by_status": service.jobs_by_status,
    "jobs_page": service.jobs_page,
    "point_lookup": service.point_lookup,
    "review_lookup": service.review_lookup,
    "newest_reviews_by_hotel": service.newest_reviews_by_hotel,
    "newest_reviews_by_platform": service.newest_reviews_by_platform,
    "hotels_by_review_count": service.hotels_by_review_count,
    "generic_page": service.generic_page,
    "table_counts": service.table_counts,
    "review_filters": service.review_filters,
    "hotel_filters": service.hotel_filters,
    "reviews_with_hotel": service.reviews_with_hotel,
    "reviews_with_job": service.reviews_with_job,
    "reviewers_dim": service.reviewers_dim,
    "schema_report": streams.schema_report,
    "stream_ingest": streams.stream_ingest,
    "stream_resume": streams.stream_resume,
    "file_runs": streams.file_runs,
    "crash_recovery": recovery.crash_recovery,
    "stream_recovery": recovery.stream_recovery,
    "stream_progress": recovery.stream_progress,
    "mixed_providers": recovery.mixed_providers,
    "folder_run": recovery.folder_run,
    "hotel_grades": recovery.hotel_grades,
    "hotel_writes": recovery.hotel_writes,
    "review_writes": recovery.review_writes,
}

ORACLE_SQL = {k: v for k, v in ORACLE.items() if k in QUERIES}
