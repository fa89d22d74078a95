"""curdle — a PySpark-native medallion pipeline (raw files → bronze → silver → gold).

Layers:
  sources/    delimited scans, the source manifest, catalog naming, test-table fixtures
  functions/  Column → Column helpers (dates, text, numeric, hashing)
  operators/  DataFrame → DataFrame building blocks (dedup, enrichment, aggregates, quality)
  plans/      bronze / silver / gold models and the pipeline runner
  streaming/  file-arrival ingestion through Structured Streaming (same bronze path)
  oracle/     independent DuckDB SQL used to check every registered query
"""

__version__ = "0.1.0"
