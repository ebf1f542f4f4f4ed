"""quarry — warehouse-style analytics pipelines expressed as Spark jobs.

Sub-packages:
  sources/    staged files: CSV/JSON/variant/parquet scans, load control, unload
  functions/  column-level helpers (scalars, variant paths, risk rules)
  operators/  DataFrame -> DataFrame operators (joins, top-k, merges, history, ML)
  streaming/  file-arrival ingest with Structured Streaming
  plans/      the named query registry and its DuckDB oracle
"""

__version__ = "0.1.0"
