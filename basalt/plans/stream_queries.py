"""Streaming queries: each drains a stream with ``availableNow`` into a sink
under the shared checkpoint folder, then reads the sink back (the batch form
of the same query is the oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.operators import alarms as A
from basalt.operators import messages as M
from basalt.operators import metrics as X
from basalt.plans import views as V
from basalt.plans.message_queries import TARGETS_SQL
from basalt.plans.metric_queries import AS_OF_ALARMS, FILE_POINTS_SQL, TEST_RULES, all_points
from basalt.plans.registry import ORACLE, register
from basalt.plans.sql_queries import write_raw_events
from basalt.session import scratch_dir
from basalt.streaming import streams as STR


def _as_stream(spark, rows, by, folder, batches=6):
    """``rows`` as a stream of ``batches`` micro-batches that are not in time order.

    Each micro-batch holds a file per core: a file of this size is one row group, which one task
    reads and works on alone."""
    files = spark.sparkContext.defaultParallelism
    rows.repartition(batches * files, F.xxhash64(*by)).write.parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _events_stream(spark, sf_dir):
    """``events`` as a stream of files that are not in time order."""
    return _as_stream(spark, V.table(spark, sf_dir, "events"), ["event_id"], scratch_dir(spark, "events-files"))


@register("stream_ingest_action_counts", oracle="""
SELECT event_type AS action, year, month, count(*) AS total
FROM (SELECT event_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month FROM events) GROUP BY 1, 2, 3""")
def stream_ingest_action_counts(spark, sf_dir):
    """Raw JSONL drained by a file-source stream into the partitioned lake."""
    root = scratch_dir(spark, "stream-ingest")
    raw = write_raw_events(spark, sf_dir, f"{root}/raw")
    q1, q2 = STR.start_ingest(spark, raw, f"{root}/lake", f"{root}/quarantine", f"{root}/_checkpoints",
                              max_files_per_trigger=2)
    q1.awaitTermination()
    q2.awaitTermination()
    lake = spark.read.parquet(f"{root}/lake")
    return lake.groupBy("action", "year", "month").agg(F.count(F.lit(1)).alias("total"))


@register("stream_rerun_is_idempotent", oracle="SELECT count(*) AS rows FROM events")
def stream_rerun_is_idempotent(spark, sf_dir):
    """Running the same ingest twice over the same files adds nothing the second time."""
    root = scratch_dir(spark, "stream-rerun")
    raw = write_raw_events(spark, sf_dir, f"{root}/raw")
    for _ in range(2):
        for q in STR.start_ingest(spark, raw, f"{root}/lake", f"{root}/quarantine", f"{root}/_checkpoints"):
            q.awaitTermination()
    return spark.read.parquet(f"{root}/lake").agg(F.count(F.lit(1)).alias("rows"))


@register("stream_five_minute_stats", oracle=V.with_views("""
SELECT metric, time_bucket(INTERVAL '5 minutes', ts) AS period_start, round(sum(value), 6) AS sum,
       round(avg(value), 6) AS average, max(value) AS maximum, count(*) AS samples
FROM pts GROUP BY 1, 2""", pts=V.with_views(FILE_POINTS_SQL, fe=V.FILE_EVENTS_SQL)))
def stream_five_minute_stats(spark, sf_dir):
    """X7 as a stream: mergeable parts per micro-batch, files out of time order, compacted on the way."""
    root = scratch_dir(spark, "stream-stats")
    points = X.file_points(V.file_events(_events_stream(spark, sf_dir)))
    STR.start_five_minute_stats(points, f"{root}/stats", f"{root}/_ck", compact_every=4).awaitTermination()
    s = STR.five_minute_stats(spark, f"{root}/stats")
    return s.select("metric", "period_start", F.round("sum", 6).alias("sum"), F.round("average", 6).alias("average"),
                    "maximum", "samples")


@register("stream_dedupe_targets", oracle=V.with_views(
    "SELECT DISTINCT bucket, key FROM t WHERE resolved", msgs=V.MESSAGES_SQL, t=TARGETS_SQL))
def stream_dedupe_targets(spark, sf_dir):
    """M8 as a stream: keys seen are streaming state, one row per (bucket, key) over all micro-batches."""
    root = scratch_dir(spark, "stream-dedupe")
    msgs = V.messages(_events_stream(spark, sf_dir))
    targets = M.resolve_target(msgs, "raw-default").where("resolved").select("bucket", "key", "message_id")
    STR.start_deduping(targets, ["bucket", "key"], ["message_id"], f"{root}/out", f"{root}/_ck").awaitTermination()
    return STR.read_table(spark, f"{root}/out", targets.schema).select("bucket", "key")


@register("stream_cycle_counters", oracle="""
SELECT count(*) AS received, count(*) FILTER (WHERE event_type <> 'error') AS processed FROM events""")
def stream_cycle_counters(spark, sf_dir):
    """A per-micro-batch handler records received / processed counts per cycle."""
    root = scratch_dir(spark, "stream-cycles")

    def handler(batch, epoch_id):
        (batch.agg(F.count(F.lit(1)).alias("received"), F.count_if(F.col("event_type") != "error").alias("processed"))
         .withColumn("cycle", F.lit(epoch_id)).write.mode("append").parquet(f"{root}/cycles"))
        return True

    STR.start_with_handler(_events_stream(spark, sf_dir), handler, f"{root}/_ck").awaitTermination()
    return spark.read.parquet(f"{root}/cycles").agg(F.sum("received").cast("bigint").alias("received"),
                                                    F.sum("processed").cast("bigint").alias("processed"))


@register("stream_worker_outcomes", oracle="""
SELECT outcome, attempts, count(*) AS messages FROM (
  SELECT unnest(CASE WHEN event_id % 10 = 0 THEN ['rejected', 'rejected', 'set aside']
                     WHEN event_id % 10 = 5 THEN ['rejected', 'accepted'] ELSE ['accepted'] END) AS outcome,
         unnest(CASE WHEN event_id % 10 = 0 THEN [1, 2, 3] WHEN event_id % 10 = 5 THEN [1, 2] ELSE [1] END) AS attempts
  FROM events) GROUP BY ALL""")
def stream_worker_outcomes(spark, sf_dir):
    """A callback per message that refuses every tenth one always and every tenth one once; only
    refused messages come back, and those refused three times are set aside."""
    root = scratch_dir(spark, "stream-worker")
    stream = _events_stream(spark, sf_dir).select("event_id")

    def handler(message: dict) -> bool:
        return message["event_id"] % 10 != 0 and (message["event_id"] % 10 != 5 or message["attempts"] > 0)

    STR.drain(lambda: STR.start_worker(stream, handler, f"{root}/out", f"{root}/_ck"))
    STR.retry_rejected(spark, handler, f"{root}/out", stream.schema)
    calls = STR.read_outcomes(spark, f"{root}/out", stream.schema)
    return calls.groupBy("outcome", "attempts").agg(F.count(F.lit(1)).alias("messages"))


def _alarm_stream(spark, sf_dir):
    root = scratch_dir(spark, "stream-alarms")
    stream = _as_stream(spark, all_points(spark, sf_dir), ["event_id", "metric"], f"{root}/points")
    rules = A.rules(spark, TEST_RULES)
    STR.start_alarms(stream, rules, f"{root}/alarms", f"{root}/_ck").awaitTermination()
    return STR.read_alarm_history(spark, f"{root}/alarms").withColumn("value", F.round("value", 6)), rules


@register("stream_alarm_history", oracle=ORACLE["alarm_history"])
def stream_alarm_history(spark, sf_dir):
    """X14 as a stream: states per rule and period, kept up to date while files arrive out of time order."""
    return _alarm_stream(spark, sf_dir)[0]


@register("stream_alarm_states", oracle=ORACLE["alarm_states"])
def stream_alarm_states(spark, sf_dir):
    """X16 from the history that the stream keeps."""
    return A.states_from_history(*_alarm_stream(spark, sf_dir), AS_OF_ALARMS)
