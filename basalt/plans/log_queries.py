"""Error-log queries (L1-L5) over worker log lines derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.operators import logs as L
from basalt.plans import views as V
from basalt.plans.registry import register

_LV = {"logs": V.LOG_LINES_SQL}
TIME_SQL = "try_strptime(nullif(regexp_extract(line, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2})', 1), ''), '%Y-%m-%d %H:%M:%S')"
RECENT_SQL = f"""
SELECT event_id AS line_no, line, {TIME_SQL} AS log_ts FROM logs
WHERE contains(line, 'ERROR')
  AND ({TIME_SQL} > {V.METRICS_END_SQL} - INTERVAL 24 HOUR OR {TIME_SQL} IS NULL)"""


def _lines(spark, sf_dir):
    return V.log_lines(V.table(spark, sf_dir, "events")).withColumnRenamed("event_id", "line_no")


@register("log_error_lines", oracle=V.with_views(
    "SELECT event_id AS line_no, line FROM logs WHERE contains(line, 'ERROR')", **_LV))
def log_error_lines(spark, sf_dir):
    """L1."""
    return L.error_lines(_lines(spark, sf_dir))


@register("log_times", oracle=V.with_views(f"SELECT event_id AS line_no, line, {TIME_SQL} AS log_ts FROM logs", **_LV))
def log_times(spark, sf_dir):
    """L2: leading time stamp of every line (NULL when missing)."""
    return _lines(spark, sf_dir).withColumn("log_ts", L.log_time("line"))


@register("log_recent_errors", oracle=V.with_views(RECENT_SQL, **_LV))
def log_recent_errors(spark, sf_dir):
    """L3: errors of the last 24 hours plus undated error lines."""
    return L.recent_errors(_lines(spark, sf_dir), V.METRICS_END, 24)


@register("log_last_errors", oracle=V.with_views(f"""
SELECT *, row_number() OVER (ORDER BY line_no) AS n FROM (
  SELECT * FROM ({RECENT_SQL}) ORDER BY line_no DESC LIMIT 5)""", **_LV))
def log_last_errors(spark, sf_dir):
    """L4: last 5 recent errors, numbered."""
    return L.last_errors(L.recent_errors(_lines(spark, sf_dir), V.METRICS_END, 24), 5)


@register("log_numbered_errors", oracle=V.with_views("""
SELECT line_no, line, row_number() OVER (ORDER BY line_no) AS n FROM logs0
""", logs0="SELECT event_id AS line_no, line FROM (" + V.LOG_LINES_SQL + ") WHERE contains(line, 'ERROR')"))
def log_numbered_errors(spark, sf_dir):
    """L4: the whole error list numbered 1..N in log order (distributed numbering)."""
    return L.number_rows(L.error_lines(_lines(spark, sf_dir)), "line_no")


@register("log_error_count", oracle=V.with_views(f"SELECT count(*) AS errors FROM ({RECENT_SQL})", **_LV))
def log_error_count(spark, sf_dir):
    """L5."""
    return L.error_count(_lines(spark, sf_dir), V.METRICS_END, 24)
