"""innkeeper: Spark-native ingestion and query engine for JSON-Lines hotel reviews.

Layers:
  functions/  Column-expression helpers (JSON-value semantics on VARIANT, coercions)
  sources/    line sources (text files, table-derived bridges), file listings
  operators/  parse/flatten/validate, store projections and merges, ledger, reads, stats
  plans/      the registered queries, composed from operators
  streaming/  Structured Streaming ingest (foreachBatch merge)
"""

__version__ = "0.1.0"
