"""Metric, series and alarm queries (X1-X18) over points derived from ``events``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from basalt.operators import alarms as A
from basalt.operators import ingest
from basalt.operators import metrics as X
from basalt.plans import views as V
from basalt.plans.registry import register

_FE = {"fe": V.FILE_EVENTS_SQL}

FILE_POINTS_SQL = """
SELECT event_id, 'FilesProcessed' AS metric, 1.0::DOUBLE AS value, 'Count' AS unit, ts, NULL::VARCHAR AS status_dim FROM fe
UNION ALL SELECT event_id, 'FileSize', file_size::DOUBLE, 'Bytes', ts, NULL FROM fe
UNION ALL SELECT event_id, 'ProcessingTime', processing_time, 'Seconds', ts, NULL FROM fe
UNION ALL SELECT event_id, 'ProcessingStatus', 1.0, 'Count', ts, status FROM fe
UNION ALL SELECT event_id, CASE WHEN status = 'SUCCESS' THEN 'FilesSuccess' ELSE 'FilesError' END, 1.0, 'Count', ts, NULL
FROM fe"""

# Queue activity per event: received and processed counts made from the event row.
QUEUE_ACTIVITY_SQL = """
SELECT event_id, ts, CAST(floor(value) AS BIGINT) % 20 AS received,
       greatest(CAST(floor(value) AS BIGINT) % 20 - event_id % 3, 0) AS processed FROM events"""
QUEUE_POINTS_SQL = """
SELECT event_id, 'SQSMessagesReceived' AS metric, received::DOUBLE AS value, 'Count' AS unit, ts FROM qa
UNION ALL SELECT event_id, 'SQSMessagesProcessed', processed::DOUBLE, 'Count', ts FROM qa
UNION ALL SELECT event_id, 'SQSSuccessRate', processed / received * 100.0, 'Percent', ts FROM qa WHERE received > 0"""

STORAGE_OPS_SQL = """
SELECT event_id, ts, CASE event_type WHEN 'view' THEN 'GET' WHEN 'purchase' THEN 'PUT' WHEN 'error' THEN 'DELETE'
                                     ELSE 'LIST' END AS operation, event_id % 5 + 1 AS count FROM events"""


def _events(spark, sf_dir):
    return V.table(spark, sf_dir, "events")


def _file_points(spark, sf_dir):
    return X.file_points(V.file_events(_events(spark, sf_dir)), keep=["event_id"])


def _queue_activity(spark, sf_dir):
    e = _events(spark, sf_dir)
    r = F.floor("value").cast("bigint") % 20
    return e.select("event_id", "ts", r.alias("received"),
                    F.greatest(r - F.col("event_id") % 3, F.lit(0)).alias("processed"))


def _storage_ops(spark, sf_dir):
    e = _events(spark, sf_dir)
    op = (F.when(F.col("event_type") == "view", "GET").when(F.col("event_type") == "purchase", "PUT")
          .when(F.col("event_type") == "error", "DELETE").otherwise("LIST"))
    return e.select("event_id", "ts", op.alias("operation"), (F.col("event_id") % 5 + 1).alias("count"))


def all_points(spark, sf_dir):
    cols = ["event_id", "metric", "value", "unit", "ts"]
    return (_file_points(spark, sf_dir).select(*cols)
            .unionByName(X.queue_points(_queue_activity(spark, sf_dir), keep=["event_id"]).select(*cols)))


ALL_POINTS_SQL = V.with_views(f"""
SELECT event_id, metric, value, unit, ts FROM ({FILE_POINTS_SQL})
UNION ALL SELECT event_id, metric, value, unit, ts FROM ({QUEUE_POINTS_SQL})""", fe=V.FILE_EVENTS_SQL,
                              qa=QUEUE_ACTIVITY_SQL)


@register("metric_file_points", oracle=V.with_views(FILE_POINTS_SQL, **_FE))
def metric_file_points(spark, sf_dir):
    """Five points per processed file."""
    p = _file_points(spark, sf_dir)
    return p.select("event_id", "metric", "value", "unit", "ts", F.col("dimensions")["Status"].alias("status_dim"))


@register("metric_queue_points", oracle=V.with_views(QUEUE_POINTS_SQL, qa=QUEUE_ACTIVITY_SQL))
def metric_queue_points(spark, sf_dir):
    """Received, processed and (when received > 0) success-rate points."""
    p = X.queue_points(_queue_activity(spark, sf_dir), keep=["event_id"])
    return p.select("event_id", "metric", "value", "unit", "ts")


@register("metric_storage_points", oracle=V.with_views("""
SELECT event_id, 'S3Operations' AS metric, count::DOUBLE AS value, 'Count' AS unit, ts, operation AS operation_dim
FROM ops""", ops=STORAGE_OPS_SQL))
def metric_storage_points(spark, sf_dir):
    """Storage operation points with an Operation dimension."""
    p = X.storage_points(_storage_ops(spark, sf_dir), keep=["event_id"])
    return p.select("event_id", "metric", "value", "unit", "ts", F.col("dimensions")["Operation"].alias("operation_dim"))


@register("metric_catalog_points", oracle="""
SELECT event_id, 'GlueTablesUpdated' AS metric, (user_id % 4)::DOUBLE AS value, 'Count' AS unit, ts
FROM events WHERE event_type = 'signup'
UNION ALL
SELECT event_id, CASE WHEN value > 10 THEN 'GlueCatalogSuccess' ELSE 'GlueCatalogError' END, 1.0, 'Count', ts
FROM events WHERE event_type = 'signup'""")
def metric_catalog_points(spark, sf_dir):
    """Catalog update points (signup events stand for catalog runs)."""
    u = (_events(spark, sf_dir).where(F.col("event_type") == "signup")
         .select("event_id", "ts", (F.col("user_id") % 4).alias("tables_updated"), (F.col("value") > 10).alias("success")))
    return X.catalog_points(u, keep=["event_id"]).select("event_id", "metric", "value", "unit", "ts")


@register("metric_last_hours", oracle=V.with_views(f"""
SELECT event_id, metric, value, unit, ts FROM ({FILE_POINTS_SQL})
WHERE ts >= {V.METRICS_END_SQL} - INTERVAL 24 HOUR AND ts < {V.METRICS_END_SQL}""", **_FE))
def metric_last_hours(spark, sf_dir):
    """Points of the last 24 hours."""
    return X.last_hours(_file_points(spark, sf_dir), V.METRICS_END, 24).select("event_id", "metric", "value", "unit", "ts")


STATS_SQL = """
SELECT metric, time_bucket(INTERVAL '5 minutes', ts) AS period_start, round(sum(value), 6) AS sum,
       round(avg(value), 6) AS average, max(value) AS maximum, count(*) AS samples
FROM pts GROUP BY 1, 2"""


def _stats(points):
    s = X.five_minute_stats(points)
    return s.select("metric", "period_start", F.round("sum", 6).alias("sum"), F.round("average", 6).alias("average"),
                    "maximum", "samples")


@register("metric_five_minute_stats", oracle=V.with_views(STATS_SQL, pts=ALL_POINTS_SQL))
def metric_five_minute_stats(spark, sf_dir):
    """5-minute Sum / Average / Maximum per metric."""
    return _stats(all_points(spark, sf_dir))


@register("metric_five_minute_by_status", oracle=V.with_views("""
SELECT metric, time_bucket(INTERVAL '5 minutes', ts) AS period_start, round(sum(value), 6) AS sum,
       round(avg(value), 6) AS average, max(value) AS maximum, count(*) AS samples
FROM pts WHERE status_dim = 'ERROR' GROUP BY 1, 2""", pts=V.with_views(FILE_POINTS_SQL, **_FE)))
def metric_five_minute_by_status(spark, sf_dir):
    """X7 with a dimension filter (D24): ProcessingStatus points with Status = ERROR."""
    s = X.five_minute_stats(_file_points(spark, sf_dir), dimensions={"Status": "ERROR"})
    return s.select("metric", "period_start", F.round("sum", 6).alias("sum"), F.round("average", 6).alias("average"),
                    "maximum", "samples")


@register("metric_key_figures", oracle=V.with_views("""
SELECT coalesce(sum(sum) FILTER (WHERE metric = 'FilesProcessed'), 0.0) AS files_processed,
       coalesce(sum(sum) FILTER (WHERE metric = 'FilesError'), 0.0) AS files_error,
       round(sum(sum) FILTER (WHERE metric = 'FilesSuccess') * 100.0::DOUBLE
             / sum(sum) FILTER (WHERE metric = 'FilesProcessed'), 4) AS success_pct,
       round(sum(sum) FILTER (WHERE metric = 'ProcessingTime')
             / sum(samples) FILTER (WHERE metric = 'ProcessingTime'), 4) AS mean_time,
       round(avg(average) FILTER (WHERE metric = 'ProcessingTime'), 4) AS mean_time_unweighted
FROM (SELECT metric, time_bucket(INTERVAL '5 minutes', ts) AS p, sum(value) AS sum, avg(value) AS average,
             count(*) AS samples FROM pts GROUP BY 1, 2)""", pts=V.with_views(FILE_POINTS_SQL, **_FE)))
def metric_key_figures(spark, sf_dir):
    """Totals, success %, weighted and unweighted mean time."""
    return X.key_figures(X.five_minute_stats(_file_points(spark, sf_dir)))


@register("metric_trend", oracle=V.with_views(STATS_SQL + " HAVING metric IN ('FilesProcessed', 'FilesError', 'ProcessingTime')",
                                              pts=V.with_views(FILE_POINTS_SQL, **_FE)))
def metric_trend(spark, sf_dir):
    """The three trend series."""
    return X.trend(_stats(_file_points(spark, sf_dir)))


@register("metric_detail", oracle=V.with_views("""
SELECT 'ProcessingTime' AS metric, round(sum(s), 6) AS total, round(sum(s) / sum(n), 4) AS mean,
       round(avg(a), 4) AS mean_unweighted, max(m) AS maximum, count(*) AS periods
FROM (SELECT time_bucket(INTERVAL '5 minutes', ts) AS p, sum(value) AS s, avg(value) AS a, max(value) AS m,
             count(*) AS n FROM pts WHERE metric = 'ProcessingTime' GROUP BY 1)""",
    pts=V.with_views(FILE_POINTS_SQL, **_FE)))
def metric_detail(spark, sf_dir):
    """Detail of ProcessingTime."""
    d = X.metric_detail(X.five_minute_stats(_file_points(spark, sf_dir)), "ProcessingTime")
    return d.withColumn("total", F.round("total", 6))


@register("metric_latest", oracle=V.with_views("""
SELECT metric, ts, value, unit FROM (
  SELECT *, row_number() OVER (PARTITION BY metric ORDER BY ts DESC, value DESC, unit DESC) AS rn FROM pts)
WHERE rn = 1""", pts=ALL_POINTS_SQL))
def metric_latest(spark, sf_dir):
    """X11: latest point per metric."""
    return X.latest_points(all_points(spark, sf_dir))


_WIDGET_VALUES = ", ".join(f"('{w}', '{m}', '{s}')" for w, m, s in X.WIDGETS)


@register("metric_widgets", oracle=V.with_views(f"""
SELECT w.widget, s.metric, w.stat, s.period_start,
       CASE w.stat WHEN 'Sum' THEN s.sum WHEN 'Average' THEN s.average WHEN 'Maximum' THEN s.maximum END AS value
FROM ({STATS_SQL}) s JOIN (VALUES {_WIDGET_VALUES}) w(widget, metric, stat) ON s.metric = w.metric""",
    pts=ALL_POINTS_SQL))
def metric_widgets(spark, sf_dir):
    """Per widget, its statistic of each 5-minute period."""
    return X.widget_series(_stats(all_points(spark, sf_dir)))


@register("metric_operations_pivot", oracle=V.with_views("""
SELECT time_bucket(INTERVAL '5 minutes', ts) AS period_start,
       sum(count::DOUBLE) FILTER (WHERE operation = 'PUT') AS PUT,
       sum(count::DOUBLE) FILTER (WHERE operation = 'GET') AS GET,
       sum(count::DOUBLE) FILTER (WHERE operation = 'DELETE') AS DELETE,
       sum(count::DOUBLE) FILTER (WHERE operation NOT IN ('PUT', 'GET', 'DELETE')) AS other
FROM ops GROUP BY 1""", ops=STORAGE_OPS_SQL))
def metric_operations_pivot(spark, sf_dir):
    """PUT / GET / DELETE and all other operations per period."""
    p = X.storage_points(_storage_ops(spark, sf_dir))
    return X.operations_by_type(p)


TEST_RULES = A.DEFAULT_RULES + [
    ("Test-BusyProcessing", "ProcessingTime", A.GREATER, 100.0, "Sum"),
    ("Test-SlowAverage", "ProcessingTime", A.GREATER, 250.0, "Average"),
    ("Test-LowQueueSuccess", "SQSSuccessRate", A.LESS, 90.0, "Average"),
    ("Test-ManyFiles", "FilesProcessed", A.GREATER, 1.0, "Sum"),
]
_RULE_VALUES = ", ".join(f"('{a}', '{m}', '{c}', {t}, '{s}')" for a, m, c, t, s in TEST_RULES)
RULES_SQL = (f"SELECT alarm, metric, comparison, threshold::DOUBLE AS threshold, statistic "
             f"FROM (VALUES {_RULE_VALUES}) r(alarm, metric, comparison, threshold, statistic)")
RULE_PERIODS_SQL = """
SELECT r.alarm, r.metric, s.period_start,
       CASE r.statistic WHEN 'Sum' THEN s.sum WHEN 'Average' THEN s.average WHEN 'Maximum' THEN s.maximum END AS value,
       CASE WHEN r.comparison = 'GreaterThanThreshold'
            THEN (CASE r.statistic WHEN 'Sum' THEN s.sum WHEN 'Average' THEN s.average ELSE s.maximum END) > r.threshold
            ELSE (CASE r.statistic WHEN 'Sum' THEN s.sum WHEN 'Average' THEN s.average ELSE s.maximum END) < r.threshold
       END AS breach
FROM st s JOIN rules r ON s.metric = r.metric"""


@register("alarm_history", oracle=V.with_views("""
SELECT c.alarm, c.metric, c.period_start, c.value, c.breach, coalesce(p.breach, false) AS prev_breach,
       CASE WHEN c.breach AND coalesce(p.breach, false) THEN 'ALARM' ELSE 'OK' END AS state
FROM rp c LEFT JOIN rp p ON c.alarm = p.alarm AND c.period_start = p.period_start + INTERVAL 300 SECOND""",
    pts=ALL_POINTS_SQL, st=STATS_SQL, rules=RULES_SQL, rp=RULE_PERIODS_SQL))
def alarm_history(spark, sf_dir):
    """Every rule's state per period (two consecutive breaching periods -> ALARM)."""
    return A.alarm_history(_stats(all_points(spark, sf_dir)), A.rules(spark, TEST_RULES))


AS_OF_ALARMS = dt.datetime(2024, 1, 30, 12, 0, 0)


def _recent_stats(spark, sf_dir):
    """Statistics of the periods that decide the states at AS_OF_ALARMS; the ts
    range is pushed through the point generator into the events scan."""
    return _stats(X.in_range(all_points(spark, sf_dir), *A.evaluation_range(AS_OF_ALARMS)))


@register("alarm_states", oracle=V.with_views("""
SELECT r.alarm, r.metric, r.comparison, r.threshold, r.statistic,
       coalesce(a.n, 0) AS periods_with_data, coalesce(a.b, 0) AS breaching_periods, a.last_value,
       CASE WHEN coalesce(a.n, 0) = 0 THEN 'INSUFFICIENT_DATA' WHEN a.b = 2 THEN 'ALARM' ELSE 'OK' END AS state
FROM rules r LEFT JOIN (
  SELECT alarm, count(*) AS n, count(*) FILTER (WHERE breach) AS b, arg_max(value, period_start) AS last_value
  FROM rp WHERE period_start >= TIMESTAMP '2024-01-30 11:50:00' AND period_start < TIMESTAMP '2024-01-30 12:00:00'
  GROUP BY alarm) a ON r.alarm = a.alarm""",
    pts=ALL_POINTS_SQL, st=STATS_SQL, rules=RULES_SQL, rp=RULE_PERIODS_SQL))
def alarm_states(spark, sf_dir):
    """State of every rule at 2024-01-30 12:00."""
    return A.alarm_states(_recent_stats(spark, sf_dir), A.rules(spark, TEST_RULES), AS_OF_ALARMS)


@register("alarm_state_counts", oracle=V.with_views("""
SELECT state, count(*) AS alarms FROM (
  SELECT r.alarm, CASE WHEN coalesce(a.n, 0) = 0 THEN 'INSUFFICIENT_DATA' WHEN a.b = 2 THEN 'ALARM' ELSE 'OK' END AS state
  FROM rules r LEFT JOIN (
    SELECT alarm, count(*) AS n, count(*) FILTER (WHERE breach) AS b
    FROM rp WHERE period_start >= TIMESTAMP '2024-01-30 11:50:00' AND period_start < TIMESTAMP '2024-01-30 12:00:00'
    GROUP BY alarm) a ON r.alarm = a.alarm
  WHERE contains(r.alarm, 'DataLake'))
GROUP BY state""", pts=ALL_POINTS_SQL, st=STATS_SQL, rules=RULES_SQL, rp=RULE_PERIODS_SQL))
def alarm_state_counts(spark, sf_dir):
    """Rules per state among those named DataLake*."""
    states = A.alarm_states(_recent_stats(spark, sf_dir), A.rules(spark, TEST_RULES), AS_OF_ALARMS)
    return A.state_counts(states, "DataLake")


@register("metric_cycle_counters", oracle="""
SELECT date_trunc('hour', ts) AS cycle, count(*) AS received, count(*) FILTER (WHERE event_type <> 'error') AS processed
FROM events GROUP BY 1""")
def metric_cycle_counters(spark, sf_dir):
    """Received / processed per hourly worker cycle."""
    e = _events(spark, sf_dir).select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("cycle"),
                                      (F.col("event_type") != "error").alias("success"))
    return X.cycle_counters(e)


@register("metric_processing_time", oracle="""
SELECT event_id, ts AS started, make_timestamp(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT)) AS finished,
       CAST(round(value * 1000000) AS BIGINT) / 1000000.0::DOUBLE AS seconds
FROM events""")
def metric_processing_time(spark, sf_dir):
    """Seconds between start and end of each item."""
    e = _events(spark, sf_dir)
    end = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.round(F.col("value") * 1000000).cast("bigint"))
    t = e.select("event_id", F.col("ts").alias("started"), end.cast("timestamp_ntz").alias("finished"))
    return t.withColumn("seconds", ingest.processing_time("started", "finished"))
