"""Ad-hoc SQL over catalogued tables (Q1-Q8).

Spark parses, optimises and runs the query itself; there is no remote
service to submit to or poll.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_TEXT = "NULL"
TEXT_ROW_CAP = 20


def execute(spark: SparkSession, query: str, database: str | None = None) -> tuple[DataFrame | None, str | None]:
    """Q1: run any SQL; returns (result, None) or (None, error text).

    Analysis errors surface here; run-time errors surface when the result is used.
    """
    try:
        before = spark.catalog.currentDatabase()
        try:
            if database:
                spark.catalog.setCurrentDatabase(database)
            return spark.sql(query), None  # names are resolved here; later queries keep their database
        finally:
            spark.catalog.setCurrentDatabase(before)
    except Exception as exc:  # the reference returns the error text
        return None, f"{type(exc).__name__}: {exc}"


@contextmanager
def named(df: DataFrame, prefix: str = "t") -> Iterator[str]:
    """A session view of ``df`` under a name of its own for the time of the block; queries
    made inside keep working after it, since their names are resolved when they are made."""
    name = f"{prefix}_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


# Q2-Q7: the query texts of the docs, over a table of (event_time ns, user_id, action).
def sample_rows_sql(table: str, n: int = 10) -> str:
    return f"SELECT * FROM {table} LIMIT {int(n)}"


def count_sql(table: str) -> str:
    return f"SELECT COUNT(*) AS total FROM {table}"


def count_per_action_sql(table: str, ordered: bool = True) -> str:
    order = " ORDER BY total DESC, action" if ordered else ""
    return f"SELECT action, COUNT(*) AS total FROM {table} GROUP BY action{order}"


def events_per_user_sql(table: str) -> str:
    return f"SELECT user_id, COUNT(*) AS events FROM {table} GROUP BY user_id ORDER BY events DESC, user_id"


def latest_events_sql(table: str, n: int = 5) -> str:
    return (f"SELECT timestamp_micros(event_time DIV 1000) AS event_ts, user_id, action FROM {table} "
            f"ORDER BY event_time DESC, user_id, action LIMIT {int(n)}")


def as_text(df: DataFrame, cap: int | None = None, order: list | None = None) -> DataFrame:
    """Q8: data rows as text (NULL shown as ``NULL``, D16) and ``rows_left`` = rows not
    shown; all rows, or the first ``cap`` (``TEXT_ROW_CAP`` is what the view shows)."""
    total = df.select(F.count(F.lit(1))).scalar()
    shown = df.orderBy(*order) if order else df
    cols = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_TEXT)).alias(c) for c in df.columns]
    if cap is None:
        return shown.select(*cols).withColumn("rows_left", F.lit(0).cast("bigint"))
    return (shown.limit(cap).select(*cols)
            .withColumn("rows_left", F.greatest(total - F.lit(cap), F.lit(0)).cast("bigint")))
