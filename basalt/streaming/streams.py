"""Structured Streaming forms of ingest, dedupe and metric windows
(S10, S11, K7, T5-T7, M8, X7, X17, U1).

* The notification loop of the reference (poll, handle, delete on success,
  retry) becomes a file-source stream: offsets and the set of files already
  seen live in the checkpoint, so a restarted or re-run query never handles
  a file twice (T6), and a failed micro-batch is re-run from its offsets
  (T7, K7: "acknowledge only after success" is the checkpoint commit).
* ``trigger(availableNow=True)`` drains what is there and stops (the
  reference's "stop after N empty polls"); a processing-time trigger polls.
* Parquet output uses the file sink, whose ``_spark_metadata`` log makes the
  write exactly-once; readers of the folder only see committed files.
* Series and dedupe give the batch result for any order of files: files need
  not arrive in event-time order, so nothing is dropped behind a watermark.
  Each micro-batch writes mergeable parts (sum, count, max per window), its
  new keys (told from the keys in the state store) or the outcome of each message
  under its own batch id, by overwriting, so a batch that is run
  again after a failure replaces its own rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from basalt.operators import alarms as A
from basalt.operators import ingest
from basalt.operators import metrics as X
from basalt.sinks.writers import PARTITION_COLUMNS
from basalt.sources.readers import CORRUPT, RAW_EVENT_SCHEMA, with_corrupt


def raw_event_stream(spark: SparkSession, raw_dir: str, schema: T.StructType = RAW_EVENT_SCHEMA,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON Lines files arriving in ``raw_dir`` as a stream; bad lines kept."""
    r = (spark.readStream.schema(with_corrupt(schema)).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(raw_dir).withColumn("_file", F.col("_metadata.file_path"))


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_ingest(spark: SparkSession, raw_dir: str, out_dir: str, quarantine_dir: str, checkpoint_root: str,
                 schema: T.StructType = RAW_EVENT_SCHEMA, date_field: str = "event_time",
                 trigger: str | None = "availableNow", max_files_per_trigger: int | None = None
                 ) -> tuple[StreamingQuery, StreamingQuery]:
    """T5/K7: stream raw files into the date-partitioned lake table and the quarantine.

    Two queries over the same source, each with its own checkpoint and file
    sink; both use the batch transform (:func:`basalt.operators.ingest.transform_for_lake`).
    """
    src = raw_event_stream(spark, raw_dir, schema, max_files_per_trigger)
    good, bad = ingest.split_good_bad(src, date_field)
    lake = ingest.transform_for_lake(good.drop("_file"), date_field)
    q_lake = _trigger(lake.writeStream.format("parquet").partitionBy(*PARTITION_COLUMNS)
                      .option("checkpointLocation", f"{checkpoint_root}/lake"), trigger).start(out_dir)
    q_bad = _trigger(ingest.quarantine_rows(bad).writeStream.format("parquet")
                     .option("checkpointLocation", f"{checkpoint_root}/quarantine"), trigger).start(quarantine_dir)
    return q_lake, q_bad


def start_with_handler(stream: DataFrame, handler: Callable[[DataFrame, int], bool], checkpoint: str,
                       trigger: str | None = "availableNow") -> StreamingQuery:
    """A user callback per micro-batch; returning False fails the batch, so it
    is retried from the same offsets (nothing is acknowledged)."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        if not handler(batch, epoch_id):
            raise RuntimeError(f"handler rejected micro-batch {epoch_id}")

    return _trigger(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), trigger).start()


ACCEPTED, REJECTED, SET_ASIDE = "accepted", "rejected", "set aside"


def outcomes(messages: DataFrame, handler: Callable[[dict], bool], max_attempts: int) -> DataFrame:
    """``handler`` called once per message (a dict of its columns), with an outcome per row.

    ``messages`` has the column ``attempts`` (earlier calls), which the handler sees too.  True accepts the message;
    False or an exception rejects it, and the last allowed rejection sets it aside.
    The calls run in the tasks, as a stream over Arrow batches."""
    schema = T.StructType([*messages.schema.fields, T.StructField("outcome", T.StringType())])

    def call(row: dict) -> bool:
        try:
            return bool(handler(row))
        except Exception:  # noqa: BLE001 - whatever the handler raises, the message is not handled
            return False

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = batch.to_pylist()  # values as Python has them: nulls are None, whole numbers int
            calls = [row["attempts"] + 1 for row in rows]
            taken = [call(row) for row in rows]
            outcome = [ACCEPTED if ok else SET_ASIDE if n >= max_attempts else REJECTED for ok, n in zip(taken, calls, strict=True)]
            columns = [pa.array(calls, pa.int32()) if name == "attempts" else column
                       for name, column in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(outcome, pa.string())], names=[*batch.schema.names, "outcome"])

    return messages.mapInArrow(run, schema)


def start_worker(stream: DataFrame, handler: Callable[[dict], bool], table_dir: str, checkpoint: str, max_attempts: int = 3,
                 trigger: str | None = "availableNow") -> StreamingQuery:
    """A worker loop with a callback per message and an acknowledgement per message.

    Each micro-batch holds the new messages and those the batch before rejected; its outcomes are
    one write under the batch's own id.  So accepted messages are not handled again, also
    after a restart; rejected ones come back with the next batch until ``max_attempts``, and a batch
    that failed as a whole replaces its outcomes.  :func:`read_outcomes` reads the
    result, :func:`retry_rejected` handles what is left when the stream has nothing new.
    A task that is lost is run again, so a message may be handled more than once, but never none."""
    spark = stream.sparkSession
    schema = _outcome_schema(stream.schema)

    def run(batch: DataFrame, epoch_id: int) -> None:
        todo = batch.withColumn("attempts", F.lit(0))
        if epoch_id > 0:
            todo = todo.unionByName(_rejected(spark, table_dir, schema, epoch_id - 1)[0])
        outcomes(todo, handler, max_attempts).write.mode("overwrite").parquet(_round_dir(table_dir, epoch_id, 0))

    return _trigger(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), trigger).start()


def _outcome_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("attempts", T.IntegerType()), T.StructField("outcome", T.StringType())])


def _round_dir(table_dir: str, batch: int, number: int) -> str:
    return f"{table_dir}/batch={batch}/round={number}"


def _rejected(spark: SparkSession, table_dir: str, schema: T.StructType, batch: int) -> tuple[DataFrame, int]:
    """What the last round of ``batch`` rejected (without outcome), and the number of that round."""
    rows = _rounds(spark, table_dir, schema).where(F.col("batch") == batch)
    last = rows.agg(F.max("round").alias("n")).first()["n"]  # one number
    if last is None:
        last = 0
    return rows.where((F.col("round") == last) & (F.col("outcome") == REJECTED)).drop("batch", "round", "outcome"), last


def _rounds(spark: SparkSession, table_dir: str, schema: T.StructType) -> DataFrame:
    parts = [T.StructField("batch", T.LongType()), T.StructField("round", T.LongType())]
    return spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(table_dir)


def read_outcomes(spark: SparkSession, table_dir: str, schema: T.StructType) -> DataFrame:
    """Every call of a worker's handler: the message, ``attempts`` so far, ``outcome``, batch and round.
    A message that is not done yet is ``rejected`` in its last row."""
    return _rounds(spark, table_dir, _outcome_schema(schema))


def retry_rejected(spark: SparkSession, handler: Callable[[dict], bool], table_dir: str, schema: T.StructType,
                   max_attempts: int = 3) -> int:
    """Handle what the newest batch of a stopped worker rejected, in rounds until all is accepted or
    set aside; returns the number of rounds.  A round is one write, and a round that died is run again."""
    whole = _outcome_schema(schema)
    batch = _rounds(spark, table_dir, whole).agg(F.max("batch").alias("n")).first()["n"]
    rounds = 0
    while batch is not None:
        left, last = _rejected(spark, table_dir, whole, batch)
        if left.isEmpty():
            break
        outcomes(left, handler, max_attempts).write.mode("overwrite").parquet(_round_dir(table_dir, batch, last + 1))
        rounds += 1
    return rounds


def _batch_dir(table_dir: str, epoch_id: int) -> str:
    return f"{table_dir}/batch={epoch_id}"


def start_deduping(stream: DataFrame, keys: list[str], order: list[str], table_dir: str, checkpoint: str,
                   trigger: str | None = "availableNow") -> StreamingQuery:
    """M8 (stream): the first row of each key over the whole stream, in a table written batch by batch.

    The keys seen are streaming state: one row per key (arrival time and row that came first, and the
    time of its last row), merged map-side and looked up in the state store, so a batch reads its own
    rows only, however long the stream has run, and nothing expires.  ``current_timestamp`` is one value
    per micro-batch and part of its offsets, so a batch that is run again has the same one; a key is new
    where its first and last row arrived together.  Of rows that arrive together the
    least by ``order`` (then the other columns) is first.  :func:`read_table` reads the result."""
    rest = [c for c in stream.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    arrived = stream.withColumn("_arrived", F.current_timestamp())
    seen = arrived.groupBy(*keys).agg(F.min(F.struct("_arrived", *ordered)).alias("_first"), F.max("_arrived").alias("_last"))

    def run(batch: DataFrame, epoch_id: int) -> None:
        new = batch.where(F.col("_first._arrived") == F.col("_last"))
        new.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).write.mode("overwrite").parquet(_batch_dir(table_dir, epoch_id))

    writer = seen.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def drain(start: Callable[[], StreamingQuery], max_empty_polls: int = 1, poll_interval: float = 0.0) -> int:
    """Run a query that stops when nothing is left (``availableNow``) again and again until
    ``max_empty_polls`` polls in a row found nothing new; returns the rows read.

    Offsets live in the query's checkpoint, so every poll goes on where the last one ended,
    and ``maxFilesPerTrigger`` on the source bounds each fetch (S11)."""
    rows = empty = 0
    while empty < max_empty_polls:
        query = start()
        query.awaitTermination()
        got = sum(p["numInputRows"] for p in query.recentProgress)
        rows, empty = rows + got, 0 if got else empty + 1
        if not got and empty < max_empty_polls:
            time.sleep(poll_interval)
    return rows


def read_table(spark: SparkSession, table_dir: str, schema: T.StructType) -> DataFrame:
    """The rows of a table written batch by batch, with the ``batch`` they came in."""
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(table_dir)
    return df


def start_alarms(points: DataFrame, rule_df: DataFrame, table_dir: str, checkpoint: str,
                 trigger: str | None = "availableNow") -> StreamingQuery:
    """X14 (stream): alarm states as points arrive, late and disordered ones included.

    State is one small row per (rule, five-minute period): the sums of the period and of the
    one before it, since every point counts as itself and as the predecessor of the next
    period.  A batch writes, under its own id, the periods that its points changed, with
    value, breach and state; :func:`read_alarm_history` takes the newest of each.
    ``rule_df`` is joined by broadcast (one row per rule)."""
    start = F.window(F.col("ts").cast("timestamp"), X.PERIOD).start.cast("timestamp_ntz")
    later = F.col("at") + F.expr(f"INTERVAL {A.PERIOD_SECONDS} SECONDS")
    matched = points.select("metric", "value", start.alias("at")).join(F.broadcast(rule_df), "metric")
    rule = ["alarm", "metric", "comparison", "threshold", "statistic"]
    twice = matched.select(*rule, "value", F.inline(F.array(
        F.struct(F.col("at").alias("period_start"), F.lit(True).alias("here")),
        F.struct(later.alias("period_start"), F.lit(False).alias("here")))))
    sides = [("cur", F.col("here")), ("prev", ~F.col("here"))]
    sums = twice.groupBy(*rule, "period_start").agg(*[f for name, side in sides for f in (
        F.sum(F.when(side, F.col("value"))).alias(f"{name}_sum"), F.max(F.when(side, F.col("value"))).alias(f"{name}_max"),
        F.count_if(side).alias(f"{name}_n"))])

    def value(name: str) -> Column:
        total, n = F.col(f"{name}_sum"), F.col(f"{name}_n")
        return F.when(n > 0, A.statistic_of(total, F.try_divide(total, n), F.col(f"{name}_max"), n))

    def run(batch: DataFrame, epoch_id: int) -> None:
        prev = F.coalesce(A.breaches(value("prev")), F.lit(False))
        (batch.where("cur_n > 0")
         .select("alarm", "metric", "period_start", value("cur").alias("value"), A.breaches(value("cur")).alias("breach"),
                 prev.alias("prev_breach"))
         .withColumn("state", A.state_of(F.col("breach"), F.col("prev_breach")))
         .write.mode("overwrite").parquet(_batch_dir(table_dir, epoch_id)))

    writer = sums.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


HISTORY = T.StructType([
    T.StructField("alarm", T.StringType()), T.StructField("metric", T.StringType()), T.StructField("period_start", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()), T.StructField("breach", T.BooleanType()), T.StructField("prev_breach", T.BooleanType()),
    T.StructField("state", T.StringType()),
])


def read_alarm_history(spark: SparkSession, table_dir: str) -> DataFrame:
    """The history that :func:`start_alarms` keeps: each (rule, period) as of the last batch that changed it."""
    keys, rest = ["alarm", "metric", "period_start"], ["value", "breach", "prev_breach", "state"]
    newest = read_table(spark, table_dir, HISTORY).groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r"))
    return newest.select(*keys, "r.*")


STAT_PARTS = T.StructType([
    T.StructField("metric", T.StringType()), T.StructField("period_start", T.TimestampNTZType()),
    T.StructField("sum", T.DoubleType()), T.StructField("maximum", T.DoubleType()), T.StructField("samples", T.LongType()),
])


def stat_parts(points: DataFrame) -> DataFrame:
    """Mergeable five-minute parts of points: sum, maximum and samples per metric and period."""
    w = F.window(F.col("ts").cast("timestamp"), X.PERIOD)
    return (points.groupBy("metric", w.alias("w"))
            .agg(F.sum("value").alias("sum"), F.max("value").alias("maximum"), F.count(F.lit(1)).alias("samples"))
            .select("metric", F.col("w.start").cast("timestamp_ntz").alias("period_start"), "sum", "maximum", "samples"))


def merge_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("metric", "period_start").agg(
        F.sum("sum").alias("sum"), F.max("maximum").alias("maximum"), F.sum("samples").alias("samples"))


def start_five_minute_stats(points: DataFrame, table_dir: str, checkpoint: str, compact_every: int = 100,
                            trigger: str | None = "availableNow") -> StreamingQuery:
    """X7 (stream): each micro-batch appends its parts; late points merge like any other.

    Every ``compact_every`` batches the parts so far are merged into one snapshot
    next to them, so a reader opens at most that many batches."""
    spark = points.sparkSession

    def run(batch: DataFrame, epoch_id: int) -> None:
        stat_parts(batch).write.mode("overwrite").parquet(_batch_dir(f"{table_dir}/parts", epoch_id))
        if (epoch_id + 1) % compact_every == 0:
            merged = merge_parts(_live_parts(spark, table_dir, epoch_id + 1))
            merged.write.mode("overwrite").parquet(_batch_dir(f"{table_dir}/merged", epoch_id + 1))

    # an empty snapshot first, so that readers always find the folder
    spark.createDataFrame([], STAT_PARTS).write.mode("overwrite").parquet(_batch_dir(f"{table_dir}/merged", 0))
    return _trigger(points.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), trigger).start()


def _live_parts(spark: SparkSession, table_dir: str, below: int | None = None) -> DataFrame:
    """The newest snapshot and the parts written after it (snapshot n covers the batches below n)."""
    merged = read_table(spark, f"{table_dir}/merged", STAT_PARTS)
    if below is not None:
        merged = merged.where(F.col("batch") < below)
    upto = F.coalesce(merged.agg(F.max("batch")).scalar(), F.lit(0))
    parts = read_table(spark, f"{table_dir}/parts", STAT_PARTS)
    return merged.where(F.col("batch") == upto).unionByName(parts.where(F.col("batch") >= upto)).drop("batch")


def five_minute_stats(spark: SparkSession, table_dir: str) -> DataFrame:
    """The series written by :func:`start_five_minute_stats`: Sum / Average / Maximum / samples."""
    m = merge_parts(_live_parts(spark, table_dir))
    return m.select("metric", "period_start", "sum", (F.col("sum") / F.col("samples")).alias("average"), "maximum",
                    "samples")
