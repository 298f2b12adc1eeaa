"""Error reports from worker logs.

Lines are filtered and parsed with built-in expressions (``contains``,
``regexp_extract``, ``try_to_timestamp``), so the scan stays in codegen; the
"last n" views are top-k selections, never a sort of the whole log.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basalt.session import written

ERROR_MARK = "ERROR"
# Leading time stamp: "yyyy-MM-dd HH:mm:ss", optionally followed by ",SSS" (D26).
STAMP_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"


def error_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """L1: lines that contain ``ERROR``."""
    return lines.where(F.col(line_col).contains(ERROR_MARK))


def log_time(line) -> Column:
    """L2: the leading time stamp of a line, NULL when there is none."""
    c = F.col(line) if isinstance(line, str) else line
    stamp = F.regexp_extract(c, STAMP_PATTERN, 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def recent_errors(lines: DataFrame, as_of: dt.datetime, hours: float = 24, line_col: str = "line") -> DataFrame:
    """L1-L3: error lines strictly newer than ``as_of - hours``; lines without a
    readable time stamp are kept."""
    cutoff = as_of - dt.timedelta(hours=hours)
    e = error_lines(lines, line_col).withColumn("log_ts", log_time(line_col))
    return e.where((F.col("log_ts") > F.lit(cutoff)) | F.col("log_ts").isNull())


def last_errors(errors: DataFrame, n: int, order_col: str | list[str] = "line_no") -> DataFrame:
    """L4: the last ``n`` errors in the order of ``order_col``, numbered 1..n (oldest
    first).  For lines read from files use :func:`log_order`."""
    keys = [order_col] if isinstance(order_col, str) else list(order_col)
    top = errors.orderBy(*[F.col(c).desc_nulls_first() for c in keys]).limit(n)
    return top.withColumn("n", F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_last() for c in keys])))


LOG_ORDER = ["log_ts", "file", "line"]


def log_order(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Lines of several log files with the columns of their order (``LOG_ORDER``): time
    stamp, then file, then text; lines without a stamp come last.  File splits are not
    read in any promised order, so a position in the scan would not do."""
    return lines.withColumn("log_ts", log_time(line_col))


def error_count(lines: DataFrame, as_of: dt.datetime, hours: float = 24, line_col: str = "line") -> DataFrame:
    """Number of recent errors."""
    return recent_errors(lines, as_of, hours, line_col).agg(F.count(F.lit(1)).alias("errors"))


def number_rows(df: DataFrame, order_col: str, name: str = "n") -> DataFrame:
    """Number rows 1..N by ``order_col`` without a single-task window.

    Rows are range-partitioned and sorted by the key and written once with the
    position Spark's ``monotonically_increasing_id`` documents (partition in the
    upper 31 bits, row in the lower 33), so both are data.  Per-partition counts
    (one row per partition) give each partition's offset.
    """
    placed = written(df.repartitionByRange(order_col).sortWithinPartitions(order_col)
                     .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_pid", F.shiftright("_at", 33))
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_at").alias("_first"))
    offsets = counts.select("_pid", "_first", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (placed.join(F.broadcast(offsets), "_pid")  # one row per partition
            .withColumn(name, (F.col("_at") - F.col("_first") + F.col("_off") + 1).cast("bigint"))
            .drop("_pid", "_off", "_first", "_at"))
