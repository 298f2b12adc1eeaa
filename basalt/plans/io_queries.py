"""Source and sink queries (S1-S9, S12, K1-K6): data made from the given tables
is written under the shared checkpoint folder with the sinks, read back with
the sources, and compared with the table itself."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt import sinks
from basalt.operators import logs as L
from basalt.operators import manifest as Mf
from basalt.operators import messages as Ms
from basalt.operators import sql as Q
from basalt.plans import views as V
from basalt.plans.registry import register
from basalt.session import scratch_dir
from basalt.sources import listing, readers

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


@register("io_jsonl_roundtrip", oracle="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def io_jsonl_roundtrip(spark, sf_dir):
    """Events written as JSON Lines and read back with an explicit schema."""
    out = scratch_dir(spark, "jsonl")
    V.table(spark, sf_dir, "events").write.option("timestampNTZFormat", readers.MICROS_NTZ).json(out)
    df = readers.read_jsonl(spark, out, EVENTS_SCHEMA, lineage=False,
                            options={"timestampNTZFormat": readers.MICROS_NTZ})
    return df.drop(readers.CORRUPT)


@register("io_json_documents_flattened", oracle="""
SELECT event_id AS "event.id", event_type AS "event.type", user_id AS "user.id", value AS "measures.value",
       CAST(json_extract(props, '$.k') AS BIGINT) AS "measures.props.k"
FROM events""")
def io_json_documents_flattened(spark, sf_dir):
    """Nested JSON array documents (1000 events each, one file per document),
    read with multiLine and flattened to dotted columns."""
    out = scratch_dir(spark, "jsondocs")
    ev = V.table(spark, sf_dir, "events")
    obj = F.to_json(F.struct(
        F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type")).alias("event"),
        F.struct(F.col("user_id").alias("id")).alias("user"),
        F.struct(F.col("value").alias("value"),
                 F.from_json("props", "k bigint").alias("props")).alias("measures")))
    docs = (ev.select((F.col("event_id") / 1000).cast("bigint").alias("doc"), F.col("event_id").alias("i"), obj.alias("j"))
            .groupBy("doc").agg(F.concat(F.lit("["), F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct("i", "j"))), lambda s: s["j"]), ","), F.lit("]")).alias("value")))
    docs.repartition("doc").write.partitionBy("doc").text(out)
    return readers.flatten(readers.read_json_document(spark, f"{out}/*", DOCUMENT_SCHEMA)).select(
        "`event.id`", "`event.type`", "`user.id`", "`measures.value`", "`measures.props.k`")


DOCUMENT_SCHEMA = (
    "event struct<id:bigint,type:string>, user struct<id:bigint>, measures struct<value:double,props:struct<k:bigint>>")


@register("io_csv_documents", oracle="SELECT doc_id, text, lang FROM documents")
def io_csv_documents(spark, sf_dir):
    """Whole texts with quotes, commas and line breaks exported as CSV and read back."""
    out = scratch_dir(spark, "csvdocs")
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    sinks.write_csv(docs, out)
    return readers.read_csv(spark, out, docs.schema)


@register("io_csv_roundtrip", oracle="SELECT * FROM orders")
def io_csv_roundtrip(spark, sf_dir):
    """Orders exported as CSV with a header and read back with its schema."""
    out = scratch_dir(spark, "csv")
    orders = V.table(spark, sf_dir, "orders")
    sinks.write_csv(orders, out)
    return readers.read_csv(spark, out, orders.schema)


@register("io_csv_inferred", oracle="SELECT * FROM orders")
def io_csv_inferred(spark, sf_dir):
    """CSV read with schema inference (numbers, texts and times)."""
    out = scratch_dir(spark, "csvinf")
    orders = V.table(spark, sf_dir, "orders")
    sinks.write_csv(orders, out)
    df = readers.read_csv(spark, out)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in orders.schema.fields])


@register("io_parquet_roundtrip", oracle="SELECT * FROM lineitem")
def io_parquet_roundtrip(spark, sf_dir):
    """Parquet written (empty frames skipped) and read back."""
    out = scratch_dir(spark, "parquet")
    li = V.table(spark, sf_dir, "lineitem")
    assert sinks.write_parquet(li.where(F.lit(False)), out + "-empty") is False
    sinks.write_parquet(li, out)
    return readers.read_parquet(spark, out)


@register("io_dataset_dispatch", oracle="SELECT * FROM customer")
def io_dataset_dispatch(spark, sf_dir):
    """Reader chosen from the file extension."""
    return readers.read_dataset(spark, f"{sf_dir.rstrip('/')}/customer.parquet")


@register("io_text_files", oracle="""
SELECT 'utf-8' AS encoding, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents""")
def io_text_files(spark, sf_dir):
    """Whole document texts written as text files, scanned with encoding
    detection; bytes per encoding."""
    out = scratch_dir(spark, "text")
    V.table(spark, sf_dir, "documents").select("text").write.text(out)
    files = readers.read_text_files(spark, out).where(~F.col("path").contains("/_"))
    files = files.where(F.col("path").endswith(".txt"))
    return files.groupBy("encoding").agg(F.sum("size").cast("bigint").alias("bytes"))


@register("io_file_listing")
def io_file_listing(spark, sf_dir):
    """Listing of a written raw + processed lake (file counts depend on the
    writer's partitioning, so rows only)."""
    root = scratch_dir(spark, "listing")
    ev = V.table(spark, sf_dir, "events")
    ev.write.partitionBy("event_type").json(f"{root}/raw")
    ev.write.partitionBy("event_type").parquet(f"{root}/processed")
    m = listing.list_lake(spark, f"{root}/raw", f"{root}/processed")
    return Mf.type_stats(m)


@register("io_listing_by_folder", oracle="""
SELECT concat('event_type=', event_type, '/day=', strftime(ts, '%Y-%m-%d')) AS folder, 1 AS files,
       CAST(sum(strlen(concat(event_id, ',', user_id)) + 1) AS BIGINT) AS size
FROM events GROUP BY 1""")
def io_listing_by_folder(spark, sf_dir):
    """A store of one text file per event type and day, listed folder group by folder group."""
    root = scratch_dir(spark, "folders")
    ev = V.table(spark, sf_dir, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"),
                                                 F.concat_ws(",", "event_id", "user_id").alias("value"))
    ev.repartition("event_type", "day").write.partitionBy("event_type", "day").text(f"{root}/raw")
    files = listing.write_listing(spark, f"{root}/raw", f"{root}/listing", depth=2)
    m = listing.list_written(files, f"{root}/raw", "raw")
    return m.groupBy(F.regexp_replace("key", "/[^/]*$", "").alias("folder")).agg(
        F.count(F.lit(1)).cast("int").alias("files"), F.sum("size").alias("size"))


@register("io_partition_scan", oracle="""
SELECT event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY 1""")
def io_partition_scan(spark, sf_dir):
    """A year/month/day table pruned to one day."""
    out = scratch_dir(spark, "parts")
    ev = V.table(spark, sf_dir, "events")
    sinks.write_partitioned(ev.select("*", F.date_format("ts", "yyyy").alias("year"), F.date_format("ts", "MM").alias("month"),
                                      F.date_format("ts", "dd").alias("day")), out)
    day = listing.read_partition(spark, out, "2024", "01", "15")
    return day.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("io_filtered_export", oracle="SELECT * FROM orders WHERE o_orderstatus = 'F'")
def io_filtered_export(spark, sf_dir):
    """K4: the filtered frame is exported only because the filter removed rows."""
    out = scratch_dir(spark, "export")
    orders = V.table(spark, sf_dir, "orders")
    written = sinks.export_filtered_csv(orders, orders.where(F.col("o_orderstatus") == "F"), out)
    assert written is not None
    return readers.read_csv(spark, out, orders.schema)


@register("io_sql_result_saved", oracle="SELECT event_type AS action, count(*) AS total FROM events GROUP BY 1")
def io_sql_result_saved(spark, sf_dir):
    """K6: a SQL result kept as CSV under a result folder and read back."""
    with Q.named(V.processed_events(V.table(spark, sf_dir, "events"))) as events:
        df, err = Q.execute(spark, Q.count_per_action_sql(events))
    path = sinks.save_result(df, scratch_dir(spark, "results"))
    return spark.read.option("header", True).schema("action string, total bigint").csv(path)


@register("io_log_files", oracle=V.with_views("""
SELECT count(*) AS errors FROM logs WHERE contains(line, 'ERROR')""", logs=V.LOG_LINES_SQL))
def io_log_files(spark, sf_dir):
    """S12 + L1: log lines written as text files and scanned back."""
    out = scratch_dir(spark, "logs")
    V.log_lines(V.table(spark, sf_dir, "events")).select(F.col("line").alias("value")).write.text(out)
    return L.error_lines(readers.read_logs(spark, out)).agg(F.count(F.lit(1)).alias("errors"))


@register("io_log_files_last", oracle=V.with_views("""
SELECT line, row_number() OVER (ORDER BY log_ts NULLS LAST, line) AS n FROM (
  SELECT line, log_ts FROM (SELECT line, try_strptime(nullif(regexp_extract(line,
    '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2})', 1), ''), '%Y-%m-%d %H:%M:%S') AS log_ts FROM logs
    WHERE contains(line, 'ERROR')) WHERE log_ts IS NOT NULL ORDER BY log_ts DESC, line DESC LIMIT 5)""", logs=V.LOG_LINES_SQL))
def io_log_files_last(spark, sf_dir):
    """S12 + L4: the last 5 dated errors of several log files, in time order."""
    out = scratch_dir(spark, "logs")
    V.log_lines(V.table(spark, sf_dir, "events")).select(F.col("line").alias("value")).repartition(5).write.text(out)
    dated = L.log_order(L.error_lines(readers.read_logs(spark, out))).where(F.col("log_ts").isNotNull())
    return L.last_errors(dated, 5, ["log_ts", "line"]).select("line", "n")


@register("io_text_previews", oracle="SELECT doc_id, text, 'utf-8' AS encoding, CAST(strlen(text) AS BIGINT) AS size FROM documents")
def io_text_previews(spark, sf_dir):
    """One text file per document, read whole with its encoding and size.

    The first line of a file names its document and tells a missing text from an empty one."""
    out = scratch_dir(spark, "texts")
    docs = V.table(spark, sf_dir, "documents")
    line = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")),
                       F.when(F.col("text").isNull(), "null").otherwise("text"))
    sinks.write_text_files(docs.select(F.concat_ws("\n", line, F.coalesce("text", F.lit(""))).alias("value")), out)
    files = readers.read_text_files(spark, out)
    shown = F.coalesce("preview", F.unhex("hex_head").cast("string"))  # of a text with NUL bytes only its hex is shown
    first = F.substring_index(shown, "\n", 1)
    doc_id, kind = F.split_part(first, F.lit(" "), F.lit(1)), F.split_part(first, F.lit(" "), F.lit(2))
    text = F.expr("substr(preview, instr(preview, '\n') + 1, length(preview) - instr(preview, '\n') - 1)")
    has_text = kind == "text"  # sizes without the first line and the line end that the writer adds
    return files.select(doc_id.try_cast("bigint").alias("doc_id"), F.when(has_text, text).alias("text"), "encoding",
                        F.when(has_text, F.col("size") - F.octet_length(first) - 2).alias("size"))


SNAPSHOT_SQL = V.with_views(f"""
WITH m AS (SELECT count(*) FILTER (WHERE source = 'raw') AS raw_files,
                  CAST(coalesce(sum(size) FILTER (WHERE source = 'raw'), 0) AS BIGINT) AS raw_size_bytes,
                  count(*) FILTER (WHERE source = 'processed') AS processed_files,
                  CAST(coalesce(sum(size) FILTER (WHERE source = 'processed'), 0) AS BIGINT) AS processed_size_bytes,
                  count(*) FILTER (WHERE source = 'processed' AND CAST(modified AS DATE) = {V.AS_OF_SQL}) AS today_files
           FROM manifest),
     q AS (SELECT count(*) FILTER (WHERE status = 'available') AS queue_messages FROM msgs),
     e AS (SELECT count(*) AS errors_24h FROM logs
           WHERE contains(line, 'ERROR') AND (try_strptime(nullif(regexp_extract(line,
             '^(\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}})', 1), ''), '%Y-%m-%d %H:%M:%S')
             > {V.METRICS_END_SQL} - INTERVAL 24 HOUR OR try_strptime(nullif(regexp_extract(line,
             '^(\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}})', 1), ''), '%Y-%m-%d %H:%M:%S') IS NULL))
SELECT raw_files, raw_size_bytes, processed_files, processed_size_bytes, today_files,
       raw_size_bytes + processed_size_bytes AS total_size_bytes, queue_messages, errors_24h,
       CASE WHEN errors_24h = 0 AND queue_messages < 10 THEN 'OK'
            WHEN errors_24h > 0 OR queue_messages > 50 THEN 'PROBLEM' ELSE 'WARNING' END AS state,
       {V.AS_OF_SQL} AS as_of
FROM m, q, e""", manifest=V.MANIFEST_SQL, msgs=V.MESSAGES_SQL, logs=V.LOG_LINES_SQL)


def _snapshot(spark, sf_dir):
    ev = V.table(spark, sf_dir, "events")
    errors = L.recent_errors(V.log_lines(ev), V.METRICS_END, 24)
    return Mf.snapshot(V.manifest(ev), Ms.queue_depth(V.messages(ev)), errors, V.AS_OF)


@register("manifest_snapshot", oracle=SNAPSHOT_SQL)
def manifest_snapshot(spark, sf_dir):
    """one-row snapshot of files, sizes, queue, errors and overall state."""
    return _snapshot(spark, sf_dir)


@register("io_snapshot_export", oracle=SNAPSHOT_SQL)
def io_snapshot_export(spark, sf_dir):
    """K5: the snapshot exported as JSON and read back with its schema."""
    snap = _snapshot(spark, sf_dir)
    path = sinks.export_snapshot(snap, scratch_dir(spark, "snapshot"), "json")
    return spark.read.schema(snap.schema).json(path)


@register("io_snapshot_export_csv", oracle=SNAPSHOT_SQL)
def io_snapshot_export_csv(spark, sf_dir):
    """K5: the snapshot exported as CSV and read back with its schema."""
    snap = _snapshot(spark, sf_dir)
    path = sinks.export_snapshot(snap, scratch_dir(spark, "snapshot"), "csv")
    return readers.read_csv(spark, path, snap.schema)
