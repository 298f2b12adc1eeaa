"""Metric points and five-minute series.

A metric point is a row ``(metric, value, unit, ts, dimensions)`` with
``dimensions MAP<STRING,STRING>``.  Events become points through
``inline(array(struct ...))``: a narrow, per-row step with no shuffle.  The
series are one hash aggregate keyed by (metric, 5-minute window), with a
partial aggregate in every task, so a metric holding most of the points is
summed inside each task before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD = "5 minutes"
PERIOD_SECONDS = 300

POINT_SCHEMA = "metric string, value double, unit string, ts timestamp_ntz, dimensions map<string,string>"

# Fixed metric names and units of the pipeline --------------------------------
FILES_PROCESSED, FILE_SIZE, PROCESSING_TIME = "FilesProcessed", "FileSize", "ProcessingTime"
PROCESSING_STATUS, FILES_SUCCESS, FILES_ERROR = "ProcessingStatus", "FilesSuccess", "FilesError"
QUEUE_RECEIVED, QUEUE_PROCESSED, QUEUE_SUCCESS_RATE = "SQSMessagesReceived", "SQSMessagesProcessed", "SQSSuccessRate"
STORAGE_OPERATIONS = "S3Operations"
CATALOG_TABLES_UPDATED, CATALOG_SUCCESS, CATALOG_ERROR = "GlueTablesUpdated", "GlueCatalogSuccess", "GlueCatalogError"
STORAGE_OPERATION_VALUES = ["PUT", "GET", "DELETE"]
# Dashboard widgets: (widget, metric, statistic), period 300 s.
WIDGETS = [
    ("Files processed", FILES_PROCESSED, "Sum"),
    ("Processing errors", FILES_ERROR, "Sum"),
    ("Processing time", PROCESSING_TIME, "Average"),
    ("File size", FILE_SIZE, "Average"),
    ("Queue messages received", QUEUE_RECEIVED, "Sum"),
    ("Queue messages processed", QUEUE_PROCESSED, "Sum"),
    ("Storage operations", STORAGE_OPERATIONS, "Sum"),
]
# -----------------------------------------------------------------------------

def _empty_dims() -> Column:
    return F.create_map().cast("map<string,string>")


def point(metric, value, unit: str = "Count", dimensions: Column | None = None) -> Column:
    """One metric point as a struct (dimensions default to an empty map).

    The point's time is the input row's ``ts`` (see :func:`_explode`)."""
    m = F.lit(metric) if isinstance(metric, str) else metric
    v = F.lit(value) if isinstance(value, (int, float)) else value
    return F.struct(m.alias("metric"), v.cast("double").alias("value"), F.lit(unit).alias("unit"),
                    (dimensions if dimensions is not None else _empty_dims()).alias("dimensions"))


def _explode(df: DataFrame, points: list[Column], keep: list[str] = (), ts: str = "ts") -> DataFrame:
    """One row per point: ``keep`` columns, then ``metric, value, unit, ts, dimensions``.

    ``inline`` turns the array of structs into columns inside whole-stage
    codegen; a conditional point that is NULL gives a row of NULLs, removed by
    the metric-name test (names are never NULL).  A higher-order
    ``filter(array, lambda)`` here would run interpreted and take the whole
    projection out of codegen (about 3x slower).  ``ts`` is the input row's
    column, not a struct field, so a time filter on the points is pushed
    through the generator down to the scan."""
    t = F.col(ts).cast("timestamp_ntz").alias("ts")
    return (df.select(*keep, t, F.inline(F.array(*points)))
            .select(*keep, "metric", "value", "unit", "ts", "dimensions")
            .where(F.col("metric").isNotNull()))


def file_points(events: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Each processed file -> count, size, time, status and success/error points."""
    ok = F.col("status") == "SUCCESS"
    return _explode(events, [
        point(FILES_PROCESSED, 1),
        point(FILE_SIZE, F.col("file_size"), "Bytes"),
        point(PROCESSING_TIME, F.col("processing_time"), "Seconds"),
        point(PROCESSING_STATUS, 1, dimensions=F.create_map(F.lit("Status"), F.col("status"))),
        point(F.when(ok, F.lit(FILES_SUCCESS)).otherwise(F.lit(FILES_ERROR)), 1),
    ], keep)


def queue_points(activity: DataFrame, keep: list[str] = ()) -> DataFrame:
    """(ts, received, processed) -> received, processed and, if received > 0, success %."""
    rate = point(QUEUE_SUCCESS_RATE, F.col("processed") / F.col("received") * 100.0, "Percent")
    return _explode(activity, [
        point(QUEUE_RECEIVED, F.col("received")),
        point(QUEUE_PROCESSED, F.col("processed")),
        F.when(F.col("received") > 0, rate),
    ], keep)


def storage_points(ops: DataFrame, keep: list[str] = ()) -> DataFrame:
    """(ts, operation, count) -> one point with an ``Operation`` dimension."""
    return _explode(ops, [point(STORAGE_OPERATIONS, F.col("count"),
                                dimensions=F.create_map(F.lit("Operation"), F.col("operation")))], keep)


def catalog_points(updates: DataFrame, keep: list[str] = ()) -> DataFrame:
    """(ts, tables_updated, success) -> tables updated + success or error."""
    return _explode(updates, [
        point(CATALOG_TABLES_UPDATED, F.col("tables_updated")),
        point(F.when(F.col("success"), F.lit(CATALOG_SUCCESS)).otherwise(F.lit(CATALOG_ERROR)), 1),
    ], keep)


def last_hours(points: DataFrame, end: dt.datetime, hours: float = 24) -> DataFrame:
    """Points with ``end - hours <= ts < end`` (a pushed-down range filter)."""
    return in_range(points, end - dt.timedelta(hours=hours), end)


def covering_range(first_period: dt.datetime, end: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """Half-open ``ts`` range holding exactly the points of the periods whose start
    lies in ``[first_period, end)``: both ends rounded up to a period boundary.

    Filtering points to this range before :func:`five_minute_stats` gives the
    same statistics for those periods, while the scan reads only that range."""
    epoch, step = dt.datetime(1970, 1, 1), dt.timedelta(seconds=PERIOD_SECONDS)

    def up(t: dt.datetime) -> dt.datetime:
        return epoch + -((epoch - t) // step) * step
    return up(first_period), up(end)


def in_range(points: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Points with ``start <= ts < end``."""
    return points.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))


def with_dimensions(points: DataFrame, dimensions: dict | None) -> DataFrame:
    """Keep points carrying every given dimension value."""
    out = points
    for k, v in (dimensions or {}).items():
        out = out.where(F.col("dimensions")[k] == F.lit(v))
    return out


def five_minute_stats(points: DataFrame, metrics: list[str] | None = None,
                      dimensions: dict | None = None) -> DataFrame:
    """Per metric and 5-minute period: Sum, Average, Maximum and samples.

    Unsorted, so later aggregates pay no global sort; order by
    ``metric, period_start`` for display."""
    p = with_dimensions(points, dimensions)
    if metrics:
        p = p.where(F.col("metric").isin(*metrics))
    w = F.window(F.col("ts").cast("timestamp"), PERIOD)
    return (p.groupBy("metric", w.alias("w"))
            .agg(F.sum("value").alias("sum"), F.avg("value").alias("average"), F.max("value").alias("maximum"),
                 F.count(F.lit(1)).alias("samples"))
            .select("metric", F.col("w.start").cast("timestamp_ntz").alias("period_start"),
                    "sum", "average", "maximum", "samples"))


def key_figures(stats: DataFrame) -> DataFrame:
    """Totals over the series: files, errors, success %, mean processing time.

    ``mean_time`` weights each period by its samples (D14); the reference's
    unweighted mean of period averages is ``mean_time_unweighted``."""
    m = F.col("metric")
    files = F.sum(F.when(m == FILES_PROCESSED, F.col("sum")))
    ok = F.sum(F.when(m == FILES_SUCCESS, F.col("sum")))
    return stats.agg(
        F.coalesce(files, F.lit(0.0)).alias("files_processed"),
        F.coalesce(F.sum(F.when(m == FILES_ERROR, F.col("sum"))), F.lit(0.0)).alias("files_error"),
        F.round(F.try_divide(ok * 100.0, files), 4).alias("success_pct"),
        F.round(F.try_divide(F.sum(F.when(m == PROCESSING_TIME, F.col("sum"))),
                             F.sum(F.when(m == PROCESSING_TIME, F.col("samples")))), 4).alias("mean_time"),
        F.round(F.avg(F.when(m == PROCESSING_TIME, F.col("average"))), 4).alias("mean_time_unweighted"),
    )


def trend(stats: DataFrame, metrics=(FILES_PROCESSED, FILES_ERROR, PROCESSING_TIME)) -> DataFrame:
    """The series behind the trend charts."""
    return stats.where(F.col("metric").isin(*metrics))


def metric_detail(stats: DataFrame, metric: str) -> DataFrame:
    """Total, mean of period averages (weighted and not), maximum and periods of one metric."""
    s = stats.where(F.col("metric") == metric)
    return s.agg(F.lit(metric).alias("metric"), F.sum("sum").alias("total"),
                 F.round(F.try_divide(F.sum("sum"), F.sum("samples")), 4).alias("mean"),
                 F.round(F.avg("average"), 4).alias("mean_unweighted"),
                 F.max("maximum").alias("maximum"), F.count(F.lit(1)).alias("periods"))


def latest_points(points: DataFrame) -> DataFrame:
    """X11: the latest point of each metric (ties: larger value, then unit)."""
    return (points.groupBy("metric").agg(F.max(F.struct("ts", "value", "unit")).alias("p"))
            .select("metric", F.col("p.ts").alias("ts"), F.col("p.value").alias("value"), F.col("p.unit").alias("unit")))


def widget_series(stats: DataFrame, widgets: list[tuple[str, str, str]] = WIDGETS) -> DataFrame:
    """Each dashboard widget's statistic per period (widget table broadcast)."""
    spark = stats.sparkSession
    w = spark.createDataFrame(widgets, "widget string, metric string, stat string")
    v = (F.when(F.col("stat") == "Sum", F.col("sum")).when(F.col("stat") == "Average", F.col("average"))
         .when(F.col("stat") == "Maximum", F.col("maximum")))
    return stats.join(F.broadcast(w), "metric").select("widget", "metric", "stat", "period_start", v.alias("value"))


def operations_by_type(points: DataFrame, values: list[str] = STORAGE_OPERATION_VALUES) -> DataFrame:
    """Storage operations per period, one column per operation of ``values`` and
    ``other`` for all further ones, so no point is left out."""
    p = points.where(F.col("metric") == STORAGE_OPERATIONS)
    w = F.window(F.col("ts").cast("timestamp"), PERIOD)
    op = F.col("dimensions")["Operation"]
    return (p.withColumn("op", F.when(op.isin(values), op).otherwise(F.lit("other")))
            .groupBy(w.start.cast("timestamp_ntz").alias("period_start"))
            .pivot("op", [*values, "other"]).agg(F.sum("value")))


def cycle_counters(items: DataFrame, cycle: str = "cycle", success: str = "success") -> DataFrame:
    """Per worker cycle (or micro-batch): items received and processed."""
    return items.groupBy(cycle).agg(F.count(F.lit(1)).alias("received"),
                                    F.count_if(F.col(success)).alias("processed"))
