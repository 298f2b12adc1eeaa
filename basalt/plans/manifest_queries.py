"""Manifest analytics queries (F1-F33, T8) over the listing derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.functions import scalars as S
from basalt.operators import ingest
from basalt.operators import manifest as M
from basalt.plans import views as V
from basalt.plans.registry import register
from basalt.session import scratch_dir

_MV = {"manifest": V.MANIFEST_SQL}

# SQL forms of the scalar helpers, for the oracle text.
NAME_SQL = "regexp_extract(key, '[^/]*$', 0)"
EXT_SQL = "CASE WHEN contains(key, '.') THEN lower(regexp_extract(key, '[^.]*$', 0)) ELSE 'sin_ext' END"
TYPE_SQL = ("CASE WHEN suffix(key, '.parquet') THEN 'PARQUET' WHEN suffix(key, '.json') THEN 'JSON' "
            "WHEN suffix(key, '.jsonl') THEN 'JSONL' WHEN suffix(key, '.csv') THEN 'CSV' "
            "WHEN suffix(key, '.txt') THEN 'TXT' WHEN suffix(key, '.metadata') THEN 'METADATA' ELSE 'OTRO' END")


def human_size_sql(c: str) -> str:
    return (f"CASE WHEN {c} = 0 THEN '0 B' "
            f"WHEN {c} / 1.0 < 1024 THEN printf('%.1f B', {c} / 1.0) "
            f"WHEN {c} / 1024.0 < 1024 THEN printf('%.1f KB', {c} / 1024.0) "
            f"WHEN {c} / 1048576.0 < 1024 THEN printf('%.1f MB', {c} / 1048576.0) "
            f"WHEN {c} / 1073741824.0 < 1024 THEN printf('%.1f GB', {c} / 1073741824.0) "
            f"ELSE printf('%.1f TB', {c} / 1099511627776.0) END")


def human_size_short_sql(c: str) -> str:
    return (f"CASE WHEN {c} < 1024 THEN concat(CAST({c} AS BIGINT), 'B') "
            f"WHEN {c} < 1048576 THEN printf('%.1fKB', {c} / 1024.0) "
            f"ELSE printf('%.1fMB', {c} / 1048576.0) END")


def _manifest(spark, sf_dir):
    return V.manifest(V.table(spark, sf_dir, "events"))


def _order():
    return [F.desc("modified"), F.asc("key"), F.asc("object_id")]


ORDER_SQL = "modified DESC, key, object_id"


@register("manifest_enriched", oracle=V.with_views(f"""
SELECT object_id, source, key, size, modified,
       {NAME_SQL} AS name, {EXT_SQL} AS ext, {TYPE_SQL} AS type,
       {human_size_sql('size')} AS size_text, {human_size_short_sql('size')} AS size_short,
       strftime(modified, '%Y-%m-%d %H:%M:%S') AS modified_text,
       ({EXT_SQL}) IN ('parquet', 'json', 'jsonl', 'csv') AS readable
FROM manifest""", **_MV))
def manifest_enriched(spark, sf_dir):
    """Name, extension, type label, human sizes, time text, readable flag."""
    return M.enrich(_manifest(spark, sf_dir))


@register("size_text_scales", oracle=f"""
SELECT o_orderkey, bytes, {human_size_sql('bytes')} AS size_text, {human_size_short_sql('bytes')} AS size_short,
       round(bytes / 1048576.0, 2) AS size_mb
FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * CAST(floor(o_totalprice) AS BIGINT) * 10 AS bytes
      FROM orders)""")
def size_text_scales(spark, sf_dir):
    """F13, F14, F27 across B..TB (byte counts made from order prices)."""
    o = V.table(spark, sf_dir, "orders")
    p = F.floor("o_totalprice").cast("bigint")
    b = o.select("o_orderkey", (p * p * 10).alias("bytes"))
    return b.select("o_orderkey", "bytes", S.human_size("bytes").alias("size_text"),
                    S.human_size_short("bytes").alias("size_short"), S.size_mb("bytes").alias("size_mb"))


@register("manifest_prefix_filter", oracle=V.with_views(
    "SELECT * FROM manifest WHERE starts_with(key, 'raw/events/')", **_MV))
def manifest_prefix_filter(spark, sf_dir):
    """F1."""
    return M.filter_prefix(_manifest(spark, sf_dir), "raw/events/")


@register("manifest_modified_on", oracle=V.with_views(
    "SELECT * FROM manifest WHERE CAST(modified AS DATE) = DATE '2024-01-15'", **_MV))
def manifest_modified_on(spark, sf_dir):
    """F2."""
    return M.filter_modified_on(_manifest(spark, sf_dir), "2024-01-15")


@register("manifest_type_filter", oracle=V.with_views(f"SELECT * FROM manifest WHERE {EXT_SQL} = 'jsonl'", **_MV))
def manifest_type_filter(spark, sf_dir):
    """F3."""
    return M.filter_type(_manifest(spark, sf_dir), "jsonl")


@register("manifest_source_filter", oracle=V.with_views("SELECT * FROM manifest WHERE source = 'processed'", **_MV))
def manifest_source_filter(spark, sf_dir):
    """F4."""
    return M.filter_source(_manifest(spark, sf_dir), "processed")


@register("manifest_supported", oracle=V.with_views(
    f"SELECT * FROM manifest WHERE ({EXT_SQL}) IN ('parquet', 'json', 'jsonl', 'csv', 'txt', 'metadata')", **_MV))
def manifest_supported(spark, sf_dir):
    """F5."""
    return M.filter_supported(_manifest(spark, sf_dir))


@register("manifest_advanced_filter", oracle=V.with_views(f"""
SELECT * FROM manifest
WHERE CAST(modified AS DATE) = DATE '2024-01-20' AND {EXT_SQL} = 'csv' AND source = 'raw'""", **_MV))
def manifest_advanced_filter(spark, sf_dir):
    """date + type + source, newest first."""
    return M.advanced_filter(_manifest(spark, sf_dir), "2024-01-20", "csv", "raw")


@register("manifest_latest_10", oracle=V.with_views(
    f"SELECT * FROM manifest ORDER BY {ORDER_SQL} LIMIT 10", **_MV))
def manifest_latest_10(spark, sf_dir):
    """F8."""
    return M.latest(_manifest(spark, sf_dir), 10)


@register("manifest_limit_with_rest", oracle=V.with_views(f"""
SELECT *, CAST(greatest((SELECT count(*) FROM manifest) - 15, 0) AS BIGINT) AS more
FROM (SELECT * FROM manifest ORDER BY {ORDER_SQL} LIMIT 15)""", **_MV))
def manifest_limit_with_rest(spark, sf_dir):
    """first 15 and how many more."""
    return M.limit_with_rest(_manifest(spark, sf_dir), 15, _order())


@register("manifest_dedupe_name_size", oracle=V.with_views(f"""
SELECT name, key, source, object_id, size, modified FROM (
  SELECT *, {NAME_SQL} AS name,
         row_number() OVER (PARTITION BY {NAME_SQL}, size
                            ORDER BY CASE WHEN source = 'raw' THEN 0 ELSE 1 END, key, source, object_id) AS rn
  FROM manifest) WHERE rn = 1""", **_MV))
def manifest_dedupe_name_size(spark, sf_dir):
    """F16: first file per (basename, size)."""
    return M.dedupe_name_size(_manifest(spark, sf_dir))


@register("manifest_union_sources", oracle=V.with_views("SELECT * FROM manifest", **_MV))
def manifest_union_sources(spark, sf_dir):
    """raw and processed listings unioned with their labels."""
    m = _manifest(spark, sf_dir)
    raw = m.where(F.col("source") == "raw").drop("source")
    processed = m.where(F.col("source") == "processed").drop("source")
    return M.union_sources(raw, processed)


@register("manifest_page_3", oracle=V.with_views(f"""
SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}) + 40 AS row_no,
       CAST((SELECT count(*) FROM manifest) AS BIGINT) AS total_rows,
       CAST(ceil((SELECT count(*) FROM manifest) / 20.0) AS BIGINT) AS total_pages
FROM (SELECT * FROM manifest ORDER BY {ORDER_SQL} LIMIT 20 OFFSET 40)""", **_MV))
def manifest_page_3(spark, sf_dir):
    """page 3 of 20 rows, numbered, with the page count."""
    return M.page(_manifest(spark, sf_dir), 3, 20, _order())


@register("manifest_deep_page", oracle="""
WITH n AS (SELECT count(*) AS rows FROM lineitem)
SELECT *, (SELECT rows FROM n) AS total_rows, CAST(ceil((SELECT rows FROM n) / 50.0) AS BIGINT) AS total_pages
FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
                                   l_discount, l_tax) AS row_no FROM lineitem)
WHERE row_no > 50 * ((SELECT rows FROM n) // 60) AND row_no <= 50 * ((SELECT rows FROM n) // 60 + 1)""")
def manifest_deep_page(spark, sf_dir):
    """A page of 50 rows far down lineitem (five sixths of it), by a page index that is written once."""
    path = scratch_dir(spark, "pages")
    rows = V.table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_discount", "l_tax"]
    M.write_page_index(rows, [F.col(c).asc() for c in order], path)
    return M.read_page(spark, path, rows.count() // 60 + 1, 50)


@register("manifest_view_columns", oracle=V.with_views(f"""
SELECT {NAME_SQL} AS name, key, {human_size_sql('size')} AS size_text, source FROM manifest""", **_MV))
def manifest_view_columns(spark, sf_dir):
    """column subset in view order."""
    return M.select_view(M.enrich(_manifest(spark, sf_dir)), ["name", "key", "size_text", "source"])


@register("manifest_count_size", oracle=V.with_views(
    "SELECT count(*) AS files, CAST(coalesce(sum(size), 0) AS BIGINT) AS total_bytes FROM manifest", **_MV))
def manifest_count_size(spark, sf_dir):
    """F20."""
    return M.count_and_size(_manifest(spark, sf_dir))


@register("manifest_size_by_source", oracle=V.with_views("""
SELECT coalesce(source, 'total') AS source, count(*) AS files, CAST(sum(size) AS BIGINT) AS total_bytes
FROM manifest GROUP BY ROLLUP (source)""", **_MV))
def manifest_size_by_source(spark, sf_dir):
    """F21."""
    return M.size_by_source(_manifest(spark, sf_dir))


@register("manifest_files_today", oracle=V.with_views(f"""
SELECT count(*) FILTER (WHERE CAST(modified AS DATE) = {V.AS_OF_SQL}) AS files_today
FROM manifest WHERE source = 'processed'""", **_MV))
def manifest_files_today(spark, sf_dir):
    """F22."""
    return M.files_on(_manifest(spark, sf_dir), V.AS_OF)


@register("manifest_recent_processed", oracle=V.with_views(f"""
SELECT key, {NAME_SQL} AS name, {human_size_sql('size')} AS size_text,
       strftime(modified, '%Y-%m-%d %H:%M:%S') AS modified_text, modified
FROM manifest WHERE source = 'processed' ORDER BY {ORDER_SQL} LIMIT 5""", **_MV))
def manifest_recent_processed(spark, sf_dir):
    """5 most recent processed files over the whole listing."""
    return M.recent_processed(_manifest(spark, sf_dir), 5)


@register("manifest_type_stats", oracle=V.with_views(f"""
SELECT {EXT_SQL} AS ext, count(*) AS files FROM manifest
WHERE source = 'raw' OR {EXT_SQL} = 'parquet' GROUP BY 1""", **_MV))
def manifest_type_stats(spark, sf_dir):
    """F24."""
    return M.type_stats(_manifest(spark, sf_dir))


@register("manifest_folder_distribution", oracle=V.with_views("""
SELECT CASE WHEN source = 'processed' THEN 'processed/' ELSE concat(split_part(key, '/', 1), '/') END AS folder,
       count(*) AS files
FROM manifest WHERE contains(key, '/') GROUP BY 1""", **_MV))
def manifest_folder_distribution(spark, sf_dir):
    """F25."""
    return M.folder_distribution(_manifest(spark, sf_dir))


@register("manifest_daily_counts", oracle=V.with_views(f"""
WITH cal AS (SELECT CAST(d AS DATE) AS day
             FROM generate_series({V.AS_OF_SQL} - INTERVAL 6 DAY, CAST({V.AS_OF_SQL} AS TIMESTAMP), INTERVAL 1 DAY) t(d)),
     c AS (SELECT CAST(modified AS DATE) AS day, count(*) AS files FROM manifest GROUP BY 1)
SELECT strftime(cal.day, '%Y-%m-%d') AS day, CAST(coalesce(c.files, 0) AS BIGINT) AS files
FROM cal LEFT JOIN c ON cal.day = c.day""", **_MV))
def manifest_daily_counts(spark, sf_dir):
    """last 7 days, zero-filled."""
    return M.daily_counts(_manifest(spark, sf_dir), V.AS_OF, 7)


@register("manifest_size_gauge", oracle=V.with_views("""
SELECT total_files, total_size_mb, total_size_mb * 0.5 AS band_low, total_size_mb * 0.9 AS threshold,
       greatest(100.0, total_size_mb * 1.2) AS axis_max
FROM (SELECT count(*) AS total_files, round(coalesce(sum(size), 0) / 1048576.0, 2) AS total_size_mb FROM manifest)""",
    **_MV))
def manifest_size_gauge(spark, sf_dir):
    """F27 + F33."""
    return M.gauge_bands(M.total_size_mb(_manifest(spark, sf_dir)))


@register("manifest_efficiency", oracle=V.with_views("""
SELECT raw_files, processed_files, raw_files + processed_files AS total_files,
       round(processed_files * 100.0 / nullif(raw_files + processed_files, 0), 1) AS efficiency_pct,
       raw_files AS pending
FROM (SELECT count(*) FILTER (WHERE source = 'raw') AS raw_files,
             count(*) FILTER (WHERE source = 'processed') AS processed_files FROM manifest)""", **_MV))
def manifest_efficiency(spark, sf_dir):
    """F28."""
    return M.efficiency(_manifest(spark, sf_dir))


@register("manifest_truncated_names", oracle=V.with_views("""
SELECT *, CASE WHEN length(regexp_extract(key, '[^/]*$', 0)) > 9
               THEN concat(substr(regexp_extract(key, '[^/]*$', 0), 1, 6), '...')
               ELSE regexp_extract(key, '[^/]*$', 0) END AS name_view,
          CASE WHEN length(key) > 19 THEN concat('...', right(key, 16)) ELSE key END AS path_view
FROM manifest""", **_MV))
def manifest_truncated_names(spark, sf_dir):
    """head cut for names (width 10), tail cut for paths (width 20)."""
    return M.truncated_names(_manifest(spark, sf_dir), 10, 20)


@register("manifest_pending_unmatched", oracle=V.with_views("""
SELECT r.* FROM manifest r
WHERE r.source = 'raw'
  AND NOT EXISTS (SELECT 1 FROM manifest p
                  WHERE p.source = 'processed'
                    AND regexp_replace(regexp_extract(p.key, '[^/]*$', 0), '\\.[^.]*$', '')
                      = regexp_replace(regexp_extract(r.key, '[^/]*$', 0), '\\.[^.]*$', ''))""", **_MV))
def manifest_pending_unmatched(spark, sf_dir):
    """Raw files without a processed file of the same stem."""
    m = _manifest(spark, sf_dir)
    return ingest.pending(m.where(F.col("source") == "raw"), m.where(F.col("source") == "processed"))


@register("processing_summary", oracle=V.with_views("""
WITH daily AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE status = 'SUCCESS') AS files,
                      count(*) FILTER (WHERE status = 'ERROR') AS errors, avg(processing_time) AS avg_time
               FROM fe GROUP BY 1)
SELECT CAST(sum(files) AS BIGINT) AS total_files, CAST(sum(errors) AS BIGINT) AS total_errors,
       round(avg(avg_time), 4) AS mean_time, strftime(max(day), '%Y-%m-%d') AS last_day FROM daily""",
    fe=V.FILE_EVENTS_SQL))
def processing_summary(spark, sf_dir):
    """F32: daily summary (files, errors, mean time) -> totals, mean, last day."""
    fe = V.file_events(V.table(spark, sf_dir, "events"))
    daily = fe.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(F.col("status") == "SUCCESS").alias("files"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
        F.avg("processing_time").alias("avg_time"))
    return M.processing_summary(daily)
