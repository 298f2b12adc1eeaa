"""Ingest -> catalog -> SQL queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.operators import catalog, ingest, sql
from basalt.plans import views as V
from basalt.plans.registry import register
from basalt.session import scratch_dir
from basalt.sinks.commits import StagedRun, file_system, files_below
from basalt.sources.readers import RAW_EVENT_SCHEMA


def write_raw_events(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Raw zone made from ``events``: JSON Lines with ISO-8601 times carrying an offset."""
    return write_raw(V.table(spark, sf_dir, "events"), folder)


def write_raw(events: DataFrame, folder: str) -> str:
    raw = events.select(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_time"),
        "user_id", F.col("event_type").alias("action"))
    raw.write.mode("overwrite").json(folder)
    return folder


def lake_table(spark: SparkSession, sf_dir: str) -> str:
    """Run the whole batch ingest and register the result; returns ``db.table``."""
    root = scratch_dir(spark, "lake")
    raw_dir = write_raw_events(spark, sf_dir, f"{root}/raw/events")
    out_dir = f"{root}/processed/events"
    ingest.ingest_batch(spark, raw_dir, out_dir, quarantine_root=f"{root}/quarantine/events")
    db = "lake_" + uuid.uuid4().hex[:8]
    catalog.create_database(spark, db, f"{root}/db")
    catalog.register_parquet_table(
        spark, db, "events", out_dir,
        [("event_time", "timestamp"), ("user_id", "bigint"), ("action", "string")],
        ["year", "month", "day"])
    return f"{db}.events"


@register("lake_ingest_action_counts", oracle="""
SELECT event_type AS action, count(*) AS total FROM events GROUP BY event_type
""")
def lake_ingest_action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: raw JSONL -> typed, date-partitioned Parquet -> catalog -> SQL (Q4)."""
    table = lake_table(spark, sf_dir)
    df, err = sql.execute(spark, sql.count_per_action_sql(table))
    if err:
        raise RuntimeError(err)
    return df


@register("lake_ingest_partition_counts", oracle="""
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       count(*) AS rows
FROM events GROUP BY 1, 2, 3
""")
def lake_ingest_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per year/month/day partition of the ingested table (one partition per row's date, D1)."""
    table = lake_table(spark, sf_dir)
    return spark.sql(f"SELECT year, month, day, count(*) AS rows FROM {table} GROUP BY year, month, day")


@register("date_partition_columns", oracle="""
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
FROM events
""")
def date_partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1/T2 without a write: ISO text -> timestamp -> zero-padded partition strings."""
    ev = V.table(spark, sf_dir, "events").select(
        "event_id", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_time"))
    return ingest.transform_for_lake(ev).select("event_id", "year", "month", "day")


def _events_view(spark: SparkSession, sf_dir: str):
    return sql.named(V.processed_events(V.table(spark, sf_dir, "events")), "lake_events")


_PE = {"lake_events": V.PROCESSED_EVENTS_SQL}


@register("sql_count", oracle=V.with_views("SELECT count(*) AS total FROM lake_events", **_PE))
def sql_count(spark, sf_dir):
    """Q3."""
    with _events_view(spark, sf_dir) as events:
        return spark.sql(sql.count_sql(events))


@register("sql_action_counts_ordered", oracle=V.with_views(
    "SELECT action, count(*) AS total FROM lake_events GROUP BY action", **_PE))
def sql_action_counts_ordered(spark, sf_dir):
    """Q4."""
    with _events_view(spark, sf_dir) as events:
        return spark.sql(sql.count_per_action_sql(events, ordered=True))


@register("sql_action_counts", oracle=V.with_views(
    "SELECT action, count(*) AS total FROM lake_events GROUP BY action", **_PE))
def sql_action_counts(spark, sf_dir):
    """Q7."""
    with _events_view(spark, sf_dir) as events:
        return spark.sql(sql.count_per_action_sql(events, ordered=False))


@register("sql_events_per_user", oracle=V.with_views(
    "SELECT user_id, count(*) AS events FROM lake_events GROUP BY user_id", **_PE))
def sql_events_per_user(spark, sf_dir):
    """Q5."""
    with _events_view(spark, sf_dir) as events:
        return spark.sql(sql.events_per_user_sql(events))


@register("sql_latest_events", oracle=V.with_views("""
SELECT make_timestamp(event_time // 1000) AS event_ts, user_id, action FROM lake_events
ORDER BY event_time DESC, user_id, action LIMIT 5""", **_PE))
def sql_latest_events(spark, sf_dir):
    """Q6: epoch-ns -> timestamp, latest 5."""
    with _events_view(spark, sf_dir) as events:
        df = spark.sql(sql.latest_events_sql(events, 5))
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@register("sql_sample_rows", oracle=V.with_views("""
SELECT event_time, user_id, action, event_id FROM lake_events ORDER BY event_id LIMIT 10""", **_PE))
def sql_sample_rows(spark, sf_dir):
    """Q2 (over an ordered view, so the sample repeats)."""
    ordered = V.processed_events(V.table(spark, sf_dir, "events")).orderBy("event_id")
    with sql.named(ordered, "lake_events") as events:
        return spark.sql(sql.sample_rows_sql(events, 10))


@register("sql_result_as_text", oracle=V.with_views("""
WITH per_user AS (SELECT user_id, count(*) AS events FROM lake_events GROUP BY user_id),
     shown AS (SELECT * FROM per_user ORDER BY events DESC, user_id LIMIT 20)
SELECT COALESCE(CAST(user_id AS VARCHAR), 'NULL') AS user_id,
       COALESCE(CAST(events AS VARCHAR), 'NULL') AS events,
       CAST(greatest((SELECT count(*) FROM per_user) - 20, 0) AS BIGINT) AS rows_left
FROM shown""", **_PE))
def sql_result_as_text(spark, sf_dir):
    """Q8: first 20 data rows as text plus rows left over."""
    with _events_view(spark, sf_dir) as events:
        df = spark.sql(sql.events_per_user_sql(events))
    return sql.as_text(df, 20, order=[F.desc("events"), F.asc("user_id")])


@register("sql_error_text", oracle="""
SELECT count(*) AS total, CAST(NULL AS VARCHAR) AS ok_error, true AS bad_failed FROM events""")
def sql_error_text(spark, sf_dir):
    """Q1: a failing query comes back as error text, next to a succeeding one
    (the text itself is engine-specific; the check is that it is there)."""
    with _events_view(spark, sf_dir) as events:
        ok, err_ok = sql.execute(spark, sql.count_sql(events))
        _, err = sql.execute(spark, f"SELECT no_such_column FROM {events}")
    return ok.select("total", F.lit(err_ok).cast("string").alias("ok_error"), F.lit(err is not None).alias("bad_failed"))


@register("ingest_quarantine_counts", oracle="""
SELECT count(*) FILTER (WHERE event_id % 97 <> 0) AS lake_rows, count(*) FILTER (WHERE event_id % 97 = 0) AS quarantined,
       'unparseable' AS reason, 1 AS attempts
FROM events""")
def ingest_quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines where every 97th is cut short; the broken lines land in
    the quarantine table (with reason and attempt), the rest in the lake."""
    root = scratch_dir(spark, "quarantine")
    ev = V.table(spark, sf_dir, "events")
    line = F.to_json(F.struct(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_time"),
        "user_id", F.col("event_type").alias("action")))
    raw = ev.select(F.when(F.col("event_id") % 97 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    raw.write.text(f"{root}/raw")
    ingest.ingest_batch(spark, f"{root}/raw", f"{root}/lake", quarantine_root=f"{root}/quarantine")
    lake_rows = spark.read.parquet(f"{root}/lake").select(F.count(F.lit(1))).scalar()
    q = spark.read.parquet(f"{root}/quarantine")
    return q.groupBy("reason", "attempts").agg(F.count(F.lit(1)).alias("quarantined")).select(
        lake_rows.alias("lake_rows"), "quarantined", "reason", "attempts")


@register("ingest_with_ledger", oracle="""
SELECT 1 AS run, 3 AS files_read, count(*) AS rows_read_ok FROM events
UNION ALL SELECT 2, 0, 0
UNION ALL SELECT 3, 1, count(DISTINCT event_type) FROM events""")
def ingest_with_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest three files, run again (nothing to read), add a file, run again (only that one)."""
    root = scratch_dir(spark, "ledger")
    raw = V.table(spark, sf_dir, "events").select(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_time"),
        "user_id", F.col("event_type").alias("action"))
    raw.repartition(3).write.json(f"{root}/raw")

    def run(n: int) -> DataFrame:
        files = f"{root}/raw/*.json"
        out = ingest.ingest_batch(spark, files, f"{root}/lake", f"{root}/quarantine", ledger_root=f"{root}/ledger")
        return out.select(F.lit(n).alias("run"), "files_read", "rows_read_ok")

    runs = [run(1), run(2)]
    last = raw.groupBy("action").agg(F.max("event_time").alias("event_time"), F.count(F.lit(1)).alias("user_id"))
    last.coalesce(1).write.mode("append").json(f"{root}/raw")
    runs.append(run(3))
    return runs[0].unionByName(runs[1]).unionByName(runs[2]).withColumn("files_read", F.col("files_read").cast("int"))


@register("ingest_retries", oracle="""
SELECT attempt, CASE WHEN attempt = 3 THEN 'set aside' ELSE 'failed' END AS status, lake_rows
FROM (SELECT unnest([1, 2, 3]) AS attempt), (SELECT count(*) AS lake_rows FROM events)""")
def ingest_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with a file that cannot be read: three attempts, then it is set aside; the rest is ingested."""
    root = scratch_dir(spark, "retries")
    raw = write_raw_events(spark, sf_dir, f"{root}/raw")
    files = [r["path"] for r in ingest._listed(spark, f"{raw}/*.json").collect()] + [f"{root}/raw/gone.json"]
    ingest.ingest_batch(spark, files, f"{root}/lake", f"{root}/quarantine", ledger_root=f"{root}/ledger")
    lake_rows = spark.read.parquet(f"{root}/lake").select(F.count(F.lit(1))).scalar()
    bad = ingest.read_ledger(spark, f"{root}/ledger").where(F.col("file").endswith("/gone.json"))
    return bad.select("attempt", "status", lake_rows.alias("lake_rows"))


@register("ingest_bad_and_missing_files", oracle="""
SELECT 'unparseable' AS reason, count(*) AS rows FROM events WHERE event_id % 97 = 0
UNION ALL SELECT 'unreadable', 2""")
def ingest_bad_and_missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch without one good row: files of broken lines, and files that are not there."""
    root = scratch_dir(spark, "all-bad")
    ev = V.table(spark, sf_dir, "events").where("event_id % 97 = 0")
    broken = ev.select(F.substring(F.to_json(F.struct("user_id", F.col("event_type").alias("action"))), 1, 12).alias("value"))
    broken.repartition(3, "value").write.text(f"{root}/raw")
    listed = [r["path"] for r in ingest._listed(spark, f"{root}/raw/*.txt").collect()]  # at most three files
    ingest.ingest_batch(spark, [*listed, f"{root}/raw/gone1", f"{root}/raw/gone2"], f"{root}/lake", f"{root}/quarantine",
                        ledger_root=f"{root}/ledger")
    return spark.read.parquet(f"{root}/quarantine").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@register("ingest_interrupted_run", oracle="""
SELECT event_type AS action, count(*) AS total FROM events GROUP BY 1""")
def ingest_interrupted_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run stops before its commit record, one right after it; the next run gives every row once."""
    root = scratch_dir(spark, "interrupted")
    raw = write_raw_events(spark, sf_dir, f"{root}/raw")
    files = [r["path"] for r in ingest._listed(spark, f"{raw}/*.json").collect()]  # one per task of the writer
    roots = (f"{root}/lake", f"{root}/quarantine")
    for recorded in (False, True):
        run = StagedRun(spark, f"{root}/ledger")
        ingest._stage_batch(run, spark, files[:1], *roots, RAW_EVENT_SCHEMA, "event_time", True)
        ingest._stage_log(run, spark, [(files[0], 1, ingest.DONE)], f"{root}/ledger", roots[1])
        if recorded:
            run.record()
    ingest.ingest_batch(spark, files, *roots, ledger_root=f"{root}/ledger")
    return ingest.read_lake(spark, roots[0], f"{root}/ledger").groupBy("action").agg(F.count(F.lit(1)).alias("total"))


@register("ingest_changed_file", oracle="""
SELECT event_type AS action, count(*) AS total FROM events WHERE event_id % 2 = 1 OR event_id % 4 = 0 GROUP BY 1""")
def ingest_changed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw files are ingested, one is written again with other rows; they replace its earlier ones."""
    root = scratch_dir(spark, "changed-file")
    ev = V.table(spark, sf_dir, "events")

    def put(name: str, rows: DataFrame) -> None:
        folder = write_raw(rows.coalesce(1), f"{root}/made/{uuid.uuid4().hex}")
        (made,) = files_below(spark, folder)
        fs, target = file_system(spark, f"{root}/raw/{name}")
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        fs.rename(file_system(spark, f"{folder}/{made}")[1], target)

    put("even.json", ev.where("event_id % 2 = 0"))
    put("odd.json", ev.where("event_id % 2 = 1"))
    for again in (True, False):
        ingest.ingest_batch(spark, f"{root}/raw", f"{root}/lake", f"{root}/quarantine", ledger_root=f"{root}/ledger",
                            replace_changed=True)
        if again:
            put("even.json", ev.where("event_id % 4 = 0"))
    return ingest.read_lake(spark, f"{root}/lake", f"{root}/ledger").groupBy("action").agg(F.count(F.lit(1)).alias("total"))


@register("ingest_output_names", oracle="""
SELECT key, regexp_replace(regexp_extract(key, '[^/]*$', 0), '\\.jsonl$', '.parquet') AS output_name
FROM (""" + V.MANIFEST_SQL + """) WHERE suffix(key, '.jsonl')""")
def ingest_output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: processed file name of each raw .jsonl key."""
    m = V.manifest(V.table(spark, sf_dir, "events")).where(F.col("key").endswith(".jsonl"))
    return m.select("key", ingest.output_name("key").alias("output_name"))


@register("ingest_pass_through", oracle="SELECT * FROM events")
def ingest_pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the date field (or with partitioning off) rows pass unchanged."""
    ev = V.table(spark, sf_dir, "events")
    return ingest.transform_for_lake(ingest.transform_for_lake(ev, "event_time"), "ts", partition_by_date=False)
