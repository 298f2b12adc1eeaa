"""Object-listing analytics.

Input: a manifest DataFrame with at least ``key STRING, size BIGINT,
modified TIMESTAMP, source STRING`` (see :mod:`basalt.sources.listing`).
Every operator is ``DataFrame -> DataFrame``; none collects to the driver.

Scale notes
-----------
* Filters (F1-F7) are plain predicates; on a Parquet manifest they reach the
  scan as pushed filters.
* Top-k (F8, F23) is ``orderBy().limit()``, planned as ``TakeOrderedAndProject``:
  every task keeps its own k rows, only k x tasks rows meet at the end.
* Counts and sums (F20-F25) are hash aggregates with a map-side partial step,
  so a hot key (one folder or type holding a third of all files) is reduced
  inside each task before the shuffle.
* Keep-first dedupe (F16) is a ``min(struct)`` aggregate, not a window: no group
  is ever sorted in one task.
* Totals next to a page or limited list use scalar subqueries, not cross joins.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basalt.functions import scalars as S

ALL_TYPES = "todos"      # F3: no type filter
ALL_SOURCES = "all"      # F4: no source filter


def enrich(df: DataFrame) -> DataFrame:
    """Add name, ext, type label, human sizes, time text and readability flags."""
    return df.select(
        "*",
        S.basename("key").alias("name"),
        S.extension("key").alias("ext"),
        S.type_label("key").alias("type"),
        S.human_size("size").alias("size_text"),
        S.human_size_short("size").alias("size_short"),
        S.timestamp_text("modified").alias("modified_text"),
        S.readable(S.extension("key")).alias("readable"),
    )


# ---- filters -----------------------------------------------------------------

def filter_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """keys under a prefix."""
    return df.where(F.col("key").startswith(prefix))


def parse_date(date_text: str) -> dt.date:
    """``YYYY-MM-DD``; anything else is rejected (ValueError)."""
    return dt.datetime.strptime(date_text, "%Y-%m-%d").date()


def filter_modified_on(df: DataFrame, day) -> DataFrame:
    """files whose modification date equals ``day``.

    Written as a half-open time range, so a Parquet manifest prunes row groups.
    """
    d = parse_date(day) if isinstance(day, str) else day
    start = dt.datetime(d.year, d.month, d.day)
    return df.where((F.col("modified") >= F.lit(start)) & (F.col("modified") < F.lit(start + dt.timedelta(days=1))))


def filter_type(df: DataFrame, file_type: str = ALL_TYPES) -> DataFrame:
    """extension equals ``file_type``; ``todos`` keeps everything."""
    if file_type == ALL_TYPES:
        return df
    return df.where(S.extension("key") == file_type.lower())


def filter_source(df: DataFrame, source: str = ALL_SOURCES) -> DataFrame:
    """``raw``, ``processed`` or ``all`` (D8: ``all`` is really both)."""
    if source == ALL_SOURCES:
        return df
    if source not in ("raw", "processed"):
        raise ValueError(f"unknown source {source!r}")
    return df.where(F.col("source") == source)


def filter_supported(df: DataFrame) -> DataFrame:
    """only suffixes the readers accept."""
    return df.where(S.supported(S.extension("key")))


def advanced_filter(df: DataFrame, day=None, file_type: str = ALL_TYPES,
                    source: str = ALL_SOURCES) -> DataFrame:
    """date + type + source, newest first (key breaks ties)."""
    out = filter_source(filter_type(df, file_type), source)
    if day is not None:
        out = filter_modified_on(out, day)
    return out.orderBy(F.desc("modified"), F.asc("key"))


# ---- top-k, limits, paging -----------------------------------------------------

def latest(df: DataFrame, n: int) -> DataFrame:
    """F8: the ``n`` most recently modified files (full tie-break on key, id)."""
    order = [F.desc("modified"), F.asc("key")] + ([F.asc("object_id")] if "object_id" in df.columns else [])
    return df.orderBy(*order).limit(n)


def limit_with_rest(df: DataFrame, n: int, order: list[Column] | None = None) -> DataFrame:
    """first ``n`` rows plus ``more`` = rows left over (never negative)."""
    total = df.select(F.count(F.lit(1))).scalar()
    head = df.orderBy(*order).limit(n) if order else df.limit(n)
    return head.withColumn("more", F.greatest(total - F.lit(n), F.lit(0)).cast("bigint"))


def page(df: DataFrame, page_no: int, page_size: int, order: list[Column]) -> DataFrame:
    """one page of a sorted listing, numbered from the page start, with page count.

    Offset + limit first, so the numbering window only sees ``page_size`` rows.  For pages far
    down a long listing see :func:`write_page_index`.
    """
    if page_no < 1 or page_size < 1:
        raise ValueError("page numbers and sizes start at 1")
    start = (page_no - 1) * page_size
    total = df.select(F.count(F.lit(1))).scalar()
    rows = df.orderBy(*order).offset(start).limit(page_size)
    return (rows.withColumn("row_no", F.row_number().over(Window.orderBy(*order)) + F.lit(start))
            .withColumn("total_rows", total.cast("bigint"))
            .withColumn("total_pages", F.ceil(total / F.lit(page_size)).cast("bigint")))


#: Rows of one file of a page index: what a page reads at most, once or twice.
PAGE_FILE_ROWS = 100_000


def write_page_index(df: DataFrame, order: list[Column], path: str, file_rows: int = PAGE_FILE_ROWS) -> None:
    """F18 for deep pages: the rows in order, as files of at most ``file_rows``, and the rank each file starts at.

    One range sort, written once; after it any page is a seek (:func:`read_page`), where offset and limit
    would bring all rows before the page to one task.  ``order`` should tell all rows apart."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", file_rows)
     .parquet(f"{path}/rows"))
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    name = F.col("file")
    files = (rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
             .select("file", "n", F.regexp_extract(name, r"^part-(\d+)", 1).cast("long").alias("task"),
                     F.regexp_extract(name, r"-c(\d+)\.", 1).cast("long").alias("part")))  # one row per file
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    (files.select("file", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
     .coalesce(1).write.parquet(f"{path}/files"))


def read_page(spark: SparkSession, path: str, page_no: int, page_size: int) -> DataFrame:
    """One page of :func:`write_page_index` (rows, row_no, total_rows, total_pages): the index names the one or
    few files that hold it, and only those are read."""
    if page_no < 1 or page_size < 1:
        raise ValueError("page numbers and sizes start at 1")
    start = (page_no - 1) * page_size
    files = spark.read.schema("file string, n long, start long").parquet(f"{path}/files")
    total = files.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    held = files.where((F.col("start") < start + page_size) & (F.col("start") + F.col("n") > start)).orderBy("start").collect()
    schema = spark.read.parquet(f"{path}/rows").schema  # of one footer
    if held:
        rows = spark.read.schema(schema).parquet(*[f"{path}/rows/{r['file']}" for r in held])
        file, at = F.col("_metadata.file_name"), F.col("_metadata.row_index")
        first = F.element_at(F.create_map(*[F.lit(x) for r in held for x in (r["file"], r["start"])]), file)
        rows = rows.select("*", (first + at + 1).alias("row_no")).where(F.col("row_no").between(start + 1, start + page_size))
    else:
        rows = spark.createDataFrame([], schema).withColumn("row_no", F.lit(None).cast("bigint"))
    return (rows.withColumn("total_rows", F.lit(total).cast("bigint"))
            .withColumn("total_pages", F.lit(-(-total // page_size)).cast("bigint")))


def select_view(df: DataFrame, columns: list[str]) -> DataFrame:
    """column subset and order for a view."""
    return df.select(*columns)


# ---- dedupe, union ---------------------------------------------------------------

def dedupe_name_size(df: DataFrame) -> DataFrame:
    """F16: one file per (basename, size); the first seen is kept.

    Listing order is raw before processed, then key; remaining columns break
    ties.  ``min(struct)`` is a partial-aggregating hash aggregate.
    """
    rank = F.when(F.col("source") == "raw", 0).otherwise(1)
    rest = [c for c in df.columns if c not in ("key", "source")]
    keyed = df.select(S.basename("key").alias("_name"), F.col("size").alias("_size"),
                      F.struct(rank.alias("_rank"), "key", "source", *rest).alias("_r"))
    return (keyed.groupBy("_name", "_size").agg(F.min("_r").alias("_r"))
            .select(F.col("_name").alias("name"), "_r.*").drop("_rank"))


def union_sources(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """one listing from both stores, each row labelled with its source."""
    return (raw.withColumn("source", F.lit("raw"))
            .unionByName(processed.withColumn("source", F.lit("processed")), allowMissingColumns=True))


# ---- aggregates --------------------------------------------------------------------

def count_and_size(df: DataFrame) -> DataFrame:
    """file count and total bytes."""
    return df.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("total_bytes"))


def size_by_source(df: DataFrame) -> DataFrame:
    """files and bytes per source plus the grand total (source NULL -> 'total')."""
    return (df.rollup("source")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("size").cast("bigint").alias("total_bytes"))
            .select(F.coalesce("source", F.lit("total")).alias("source"), "files", "total_bytes"))


def files_on(df: DataFrame, as_of) -> DataFrame:
    """processed files modified on ``as_of``."""
    d = parse_date(as_of) if isinstance(as_of, str) else as_of
    start = dt.datetime(d.year, d.month, d.day)
    day = (F.col("modified") >= F.lit(start)) & (F.col("modified") < F.lit(start + dt.timedelta(days=1)))
    return df.where((F.col("source") == "processed") & day).agg(F.count(F.lit(1)).alias("files_today"))


def recent_processed(df: DataFrame, n: int = 5) -> DataFrame:
    """the ``n`` most recent processed files, over the whole listing."""
    top = latest(df.where(F.col("source") == "processed"), n)
    return top.select("key", S.basename("key").alias("name"), S.human_size("size").alias("size_text"),
                      S.timestamp_text("modified").alias("modified_text"), "modified")


def type_stats(df: DataFrame) -> DataFrame:
    """files per extension; every raw file, processed files only if Parquet."""
    ext = S.extension("key")
    return (df.where((F.col("source") == "raw") | (ext == "parquet"))
            .groupBy(ext.alias("ext")).agg(F.count(F.lit(1)).alias("files")))


def folder_distribution(df: DataFrame) -> DataFrame:
    """files per first folder; processed files under one label; no-folder keys ignored."""
    folder = (F.when(F.col("source") == "processed", F.lit("processed/"))
              .otherwise(F.concat(F.substring_index("key", "/", 1), F.lit("/"))))
    return (df.where(F.col("key").contains("/"))
            .groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files")))


def daily_counts(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    """files per day for the ``days`` days ending ``as_of``, zero-filled.

    The calendar is generated by ``sequence`` (``days`` rows) and left-joined to
    per-day counts that were aggregated first, so the join sees ``days`` rows per side.
    """
    d = parse_date(as_of) if isinstance(as_of, str) else as_of
    first = d - dt.timedelta(days=days - 1)
    counts = (df.where((F.col("modified") >= F.lit(dt.datetime(first.year, first.month, first.day)))
                       & (F.col("modified") < F.lit(dt.datetime(d.year, d.month, d.day) + dt.timedelta(days=1))))
              .groupBy(F.to_date("modified").alias("day")).agg(F.count(F.lit(1)).alias("files")))
    cal = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(d), F.expr("INTERVAL 1 DAY"))).alias("day"))
    return (cal.join(F.broadcast(counts), "day", "left")
            .select(F.date_format("day", "yyyy-MM-dd").alias("day"),
                    F.coalesce("files", F.lit(0)).cast("bigint").alias("files")))


def total_size_mb(df: DataFrame) -> DataFrame:
    """total files and size in MB with 2 decimals."""
    return df.agg(F.count(F.lit(1)).alias("total_files"),
                  S.size_mb(F.coalesce(F.sum("size"), F.lit(0))).alias("total_size_mb"))


def gauge_bands(size_mb_df: DataFrame) -> DataFrame:
    """gauge numbers of a total size: half, 90 % mark, axis maximum."""
    t = F.col("total_size_mb")
    return size_mb_df.select(
        "*",
        (t * 0.5).alias("band_low"),
        (t * 0.9).alias("threshold"),
        F.greatest(F.lit(100.0), t * 1.2).alias("axis_max"),
    )


def efficiency(df: DataFrame) -> DataFrame:
    """processed share of all files in %, total, processed and pending.

    ``pending`` is the reference's figure (all raw files); ``pending_unmatched``
    comes from :func:`basalt.operators.ingest.pending` when a stem match is wanted.
    """
    agg = df.agg(F.count_if(F.col("source") == "raw").alias("raw_files"),
                 F.count_if(F.col("source") == "processed").alias("processed_files"))
    total = F.col("raw_files") + F.col("processed_files")
    return agg.select(
        "raw_files", "processed_files", total.alias("total_files"),
        F.round(F.try_divide(F.col("processed_files") * 100.0, total), 1).alias("efficiency_pct"),
        F.col("raw_files").alias("pending"),
    )


def system_state(errors: Column, queue_messages: Column) -> Column:
    """OK / PROBLEM / WARNING from error count and queue depth."""
    return (F.when((errors == 0) & (queue_messages < 10), F.lit("OK"))
            .when((errors > 0) | (queue_messages > 50), F.lit("PROBLEM"))
            .otherwise(F.lit("WARNING")))


def snapshot(manifest: DataFrame, queue_depth: DataFrame, errors: DataFrame, as_of) -> DataFrame:
    """one-row snapshot of counts, sizes, queue, errors, today's files and state.

    Each input is reduced to one row by its own aggregate; the row is put
    together with scalar subqueries (no join of unbounded sides).
    """
    d = parse_date(as_of) if isinstance(as_of, str) else as_of
    m = manifest.agg(
        F.count_if(F.col("source") == "raw").alias("raw_files"),
        F.coalesce(F.sum(F.when(F.col("source") == "raw", F.col("size"))), F.lit(0)).cast("bigint").alias("raw_size_bytes"),
        F.count_if(F.col("source") == "processed").alias("processed_files"),
        F.coalesce(F.sum(F.when(F.col("source") == "processed", F.col("size"))), F.lit(0)).cast("bigint").alias("processed_size_bytes"),
        F.count_if((F.col("source") == "processed") & (F.to_date("modified") == F.lit(d))).alias("today_files"),
    )
    queue = queue_depth.select(F.col("messages_available").cast("bigint")).scalar()
    errs = errors.select(F.count(F.lit(1))).scalar()
    return (m.withColumn("total_size_bytes", F.col("raw_size_bytes") + F.col("processed_size_bytes"))
            .withColumn("queue_messages", queue)
            .withColumn("errors_24h", errs)
            .withColumn("state", system_state(F.col("errors_24h"), F.col("queue_messages")))
            .withColumn("as_of", F.lit(d)))


def processing_summary(daily: DataFrame) -> DataFrame:
    """F32: totals of a daily processing summary (day, files, errors, time)."""
    return daily.agg(
        F.sum("files").cast("bigint").alias("total_files"),
        F.sum("errors").cast("bigint").alias("total_errors"),
        F.round(F.avg("avg_time"), 4).alias("mean_time"),
        F.date_format(F.max("day"), "yyyy-MM-dd").alias("last_day"),
    )


def truncated_names(df: DataFrame, name_width: int = 30, path_width: int = 40) -> DataFrame:
    """list view with long names cut at the head and long paths at the tail."""
    return df.select("*", S.truncate_head(S.basename("key"), name_width).alias("name_view"),
                     S.truncate_tail("key", path_width).alias("path_view"))
