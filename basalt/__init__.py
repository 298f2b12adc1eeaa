"""basalt: data-lake analytics as DataFrame-to-DataFrame functions on Spark.

Sub-packages
------------
sources    readers for JSON Lines / JSON / CSV / Parquet / text, file listings, logs
sinks      Parquet (plain and date-partitioned), CSV, JSON snapshot and SQL-result writers
operators  ingest, queue messages, catalog, SQL, manifest analytics, profiling,
           exploration, metric series, alarms and error logs
functions  Column -> Column helpers (sizes, names, extensions, previews)
plans      the registered queries and the views they are built on
streaming  Structured Streaming forms of ingest, dedupe and metric windows
"""

from basalt.session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
