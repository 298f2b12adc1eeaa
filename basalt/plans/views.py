"""Inputs of the registered queries, derived from the given tables.

The reference works on object listings, queue messages, metric points and log
lines.  The test tables hold none of those, so each shape is derived from
``events`` by the rules of FIXTURES.md 3.2: row counts grow with ``events``,
and the same derivation exists as SQL text for the DuckDB oracle
(``*_SQL`` below), so both sides see identical rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# "Today" for operators that need one (fixed, so results repeat).
AS_OF = dt.date(2024, 1, 30)
AS_OF_SQL = "DATE '2024-01-30'"
# End of the metric look-back windows: midnight after the last event day.
METRICS_END = dt.datetime(2024, 1, 31, 0, 0, 0)
METRICS_END_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _user(c: str = "user_id"):
    return F.col(c).cast("string")


def manifest(events: DataFrame) -> DataFrame:
    """Object listing: (object_id, source, key, size, modified)."""
    raw = (F.col("user_id") % 2) == 0
    folder = (F.when((F.col("event_id") % 50) == 0, F.lit(""))
              .when(raw, F.lit("raw/events/incoming/"))
              .otherwise(F.lit("processed/events/")))
    suffix = (F.when(F.col("event_type") == "click", ".jsonl")
              .when(F.col("event_type") == "view", ".parquet")
              .when(F.col("event_type") == "purchase", ".csv")
              .when(F.col("event_type") == "signup", ".txt")
              .otherwise(""))
    return events.select(
        F.col("event_id").alias("object_id"),
        F.when(raw, "raw").otherwise("processed").alias("source"),
        F.concat(folder, F.lit("f"), _user(), suffix).alias("key"),
        (F.floor("value").cast("bigint") * 1024).alias("size"),
        F.col("ts").alias("modified"),
    )


MANIFEST_SQL = """
SELECT event_id AS object_id,
       CASE WHEN user_id % 2 = 0 THEN 'raw' ELSE 'processed' END AS source,
       concat(CASE WHEN event_id % 50 = 0 THEN ''
                   WHEN user_id % 2 = 0 THEN 'raw/events/incoming/'
                   ELSE 'processed/events/' END,
              'f', CAST(user_id AS VARCHAR),
              CASE event_type WHEN 'click' THEN '.jsonl' WHEN 'view' THEN '.parquet'
                              WHEN 'purchase' THEN '.csv' WHEN 'signup' THEN '.txt' ELSE '' END) AS key,
       CAST(floor(value) AS BIGINT) * 1024 AS size,
       ts AS modified
FROM events
"""


def messages(events: DataFrame) -> DataFrame:
    """Queue messages: (message_id, body, status, sent_ms, receive_count_attr)."""
    key = F.concat(F.lit("raw/events/incoming/f"), _user(), F.lit(".jsonl"))
    def record(name: str):
        return F.concat(F.lit('{"s3":{"bucket":{"name":"b'), (F.col("user_id") % 3).cast("string"),
                        F.lit('"},"object":{"key":"raw/events/incoming/' + name), _user(), F.lit('.jsonl"}}}'))

    body = (F.when(F.col("event_type") == "error", F.concat(F.lit("  "), key, F.lit(" ")))
            .when((F.col("event_type") == "signup") & (F.col("event_id") % 5 == 0),
                  F.concat(F.lit('{"key":"'), key, F.lit('"}}')))
            .when(F.col("event_type") == "signup",
                  F.concat(F.lit('{"key":"'), key, F.lit('","kind":"custom"}')))
            .when(F.col("event_type") == "view",
                  F.concat(F.lit('{"Records":['), record("f"), F.lit(","), record("g"), F.lit("]}")))
            .when((F.col("event_type") == "purchase") & (F.col("event_id") % 3 == 0), F.lit('{"Records":[]}'))
            .otherwise(F.concat(F.lit('{"Records":['), record("f"), F.lit("]}"))))
    status = (F.when((F.col("event_id") % 10) == 0, "delayed")
              .when((F.col("event_id") % 4) == 0, "in_flight")
              .otherwise("available"))
    return events.select(
        F.col("event_id").cast("string").alias("message_id"),
        body.alias("body"),
        status.alias("status"),
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("sent_ms"),
        (F.col("event_id") % 4).cast("string").alias("receive_count_attr"),
    )


MESSAGES_SQL = """
SELECT CAST(event_id AS VARCHAR) AS message_id,
       CASE WHEN event_type = 'error'
            THEN concat('  raw/events/incoming/f', CAST(user_id AS VARCHAR), '.jsonl ')
            WHEN event_type = 'signup' AND event_id % 5 = 0
            THEN concat('{"key":"raw/events/incoming/f', CAST(user_id AS VARCHAR), '.jsonl"}}')
            WHEN event_type = 'signup'
            THEN concat('{"key":"raw/events/incoming/f', CAST(user_id AS VARCHAR), '.jsonl","kind":"custom"}')
            WHEN event_type = 'view'
            THEN concat('{"Records":[{"s3":{"bucket":{"name":"b', CAST(user_id % 3 AS VARCHAR),
                        '"},"object":{"key":"raw/events/incoming/f', CAST(user_id AS VARCHAR), '.jsonl"}}},',
                        '{"s3":{"bucket":{"name":"b', CAST(user_id % 3 AS VARCHAR),
                        '"},"object":{"key":"raw/events/incoming/g', CAST(user_id AS VARCHAR), '.jsonl"}}}]}')
            WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN '{"Records":[]}'
            ELSE concat('{"Records":[{"s3":{"bucket":{"name":"b', CAST(user_id % 3 AS VARCHAR),
                        '"},"object":{"key":"raw/events/incoming/f', CAST(user_id AS VARCHAR), '.jsonl"}}}]}')
       END AS body,
       CASE WHEN event_id % 10 = 0 THEN 'delayed' WHEN event_id % 4 = 0 THEN 'in_flight'
            ELSE 'available' END AS status,
       CAST(epoch_us(ts) // 1000 AS VARCHAR) AS sent_ms,
       CAST(event_id % 4 AS VARCHAR) AS receive_count_attr
FROM events
"""


def file_events(events: DataFrame) -> DataFrame:
    """File-processed events, the input of the metric operators."""
    return events.select(
        "event_id", "ts",
        (F.floor("value").cast("bigint") * 1024).alias("file_size"),
        F.col("value").alias("processing_time"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("SUCCESS").alias("status"),
    )


FILE_EVENTS_SQL = """
SELECT event_id, ts, CAST(floor(value) AS BIGINT) * 1024 AS file_size, value AS processing_time,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS status
FROM events
"""


def log_lines(events: DataFrame) -> DataFrame:
    """Worker log lines; every 97th has no time stamp."""
    stamp = F.when((F.col("event_id") % 97) == 0, F.lit("Traceback")).otherwise(
        F.substring(F.col("ts").cast("string"), 1, 19))
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    return events.select(
        "event_id",
        F.concat(stamp, F.lit(" "), level, F.lit(" run_worker event "),
                 F.col("event_id").cast("string")).alias("line"),
    )


LOG_LINES_SQL = """
SELECT event_id,
       concat(CASE WHEN event_id % 97 = 0 THEN 'Traceback' ELSE substr(CAST(ts AS VARCHAR), 1, 19) END, ' ',
              CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END,
              ' run_worker event ', CAST(event_id AS VARCHAR)) AS line
FROM events
"""


def processed_events(events: DataFrame) -> DataFrame:
    """The processed event table of the docs: event_time as epoch-ns BIGINT, user_id, action."""
    return events.select(
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("event_time"),
        "user_id",
        F.col("event_type").alias("action"),
        "event_id",
    )


PROCESSED_EVENTS_SQL = """
SELECT epoch_us(ts) * 1000 AS event_time, user_id, event_type AS action, event_id FROM events
"""


def with_views(sql: str, **views: str) -> str:
    """Prefix an oracle query with ``WITH name AS (view sql)`` clauses."""
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in views.items())
    if not ctes:
        return sql
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{sql}"
