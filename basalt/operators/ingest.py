"""Raw JSON Lines -> typed rows -> date-partitioned Parquet.

Batch and stream share :func:`transform_for_lake`, so a streaming micro-batch
and a batch run write the same rows.  Every row is filed under its own date
(D1), bad lines go to a quarantine table instead of failing the file (D5),
and files already ingested are skipped through a ledger before they are read (T6).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.session import written
from basalt.sinks.commits import StagedRun, files_below, recover
from basalt.sinks.writers import PARTITION_COLUMNS, observed
from basalt.sources.readers import CORRUPT, RAW_EVENT_SCHEMA, read_jsonl


def parse_time(col) -> Column:
    """ISO-8601 text (with or without offset) -> timestamp; NULL if unparseable."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c)


def date_partitions(ts) -> list[Column]:
    """Zero-padded ``year``, ``month``, ``day`` strings of a timestamp."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return [F.date_format(t, "yyyy").alias("year"), F.date_format(t, "MM").alias("month"),
            F.date_format(t, "dd").alias("day")]


def transform_for_lake(df: DataFrame, date_field: str = "event_time", partition_by_date: bool = True) -> DataFrame:
    """Parse the date field and add partition columns, per row.

    Without the field, or with partitioning off, the frame passes through (T3).
    """
    if not partition_by_date or date_field not in df.columns:
        return df
    ts = parse_time(date_field) if isinstance(df.schema[date_field].dataType, T.StringType) else F.col(date_field)
    out = df.withColumn(date_field, ts)
    return out.select("*", *date_partitions(date_field))


def output_name(file_col="_file") -> Column:
    """T4: output file name: basename with ``.jsonl`` replaced by ``.parquet``."""
    c = F.col(file_col) if isinstance(file_col, str) else file_col
    return F.regexp_replace(F.substring_index(c, "/", -1), r"\.jsonl$", ".parquet")


def is_bad(df: DataFrame, date_field: str = "event_time", corrupt: str = CORRUPT) -> Column:
    """Whether a row goes to the quarantine: it did not parse, or its date did not."""
    bad = F.col(corrupt).isNotNull()
    if date_field in df.columns:
        bad = bad | (F.col(date_field).isNotNull() & parse_time(date_field).isNull())
    return bad


def split_good_bad(df: DataFrame, date_field: str = "event_time", corrupt: str = CORRUPT):
    """Rows that parsed (and have a usable date when one is required) vs. the rest."""
    bad = is_bad(df, date_field, corrupt)
    return df.where(~bad).drop(corrupt), df.where(bad)


def quarantine_rows(bad: DataFrame, reason: str = "unparseable", corrupt: str = CORRUPT,
                    attempt: int = 1) -> DataFrame:
    """Bad rows kept aside with the file, the raw text, reason and attempt number."""
    raw_text = F.coalesce(F.col(corrupt), F.to_json(F.struct(*[c for c in bad.columns if c not in (corrupt, "_file")])))
    return bad.select(
        F.col("_file").alias("file") if "_file" in bad.columns else F.lit(None).cast("string").alias("file"),
        raw_text.alias("raw"),
        F.lit(reason).alias("reason"),
        F.lit(attempt).alias("attempts"),
    )


LEDGER_SCHEMA = "file string, attempt int, status string, stamp string"
DONE, FAILED, SET_ASIDE = "done", "failed", "set aside"


def file_name(path) -> Column:
    """One normal form of a file path: without scheme, with single slashes."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:", ""), "/+", "/")


def unprocessed(files: DataFrame, ledger: DataFrame, by_stamp: bool = False) -> DataFrame:
    """Listed files (column ``path``) that the ledger has neither done nor set aside; with
    ``by_stamp`` also those whose ``stamp`` (time and size) is not one it has settled."""
    settled = ledger.where(F.col("status").isin(DONE, SET_ASIDE)).select(F.col("file").alias("_file"), F.col("stamp").alias("_stamp")).distinct()
    same = file_name("path") == F.col("_file")
    if by_stamp:
        same = same & (F.col("stamp").isNull() | F.col("_stamp").isNull() | (F.col("stamp") == F.col("_stamp")))
    return files.join(settled, same, "left_anti")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Every attempt on every file (file, attempt, status)."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(root)


def pending(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw files without a processed counterpart, matched on the file stem."""
    stem = lambda c: F.regexp_replace(F.substring_index(F.col(c), "/", -1), r"\.[^.]*$", "")
    r = raw.withColumn("_stem", stem("key"))
    p = processed.select(stem("key").alias("_stem")).distinct()
    return r.join(p, "_stem", "left_anti").drop("_stem")


def ingest_batch(spark: SparkSession, paths, out_root: str, quarantine_root: str | None = None,
                 schema: T.StructType | None = RAW_EVENT_SCHEMA, date_field: str = "event_time",
                 partition_by_date: bool = True, ledger_root: str | None = None, max_attempts: int = 3,
                 max_files: int = 10_000, replace_changed: bool = False) -> DataFrame:
    """T5: read JSONL files, transform, write partitioned Parquet, quarantine bad rows.

    Returns a one-row summary (files_read, rows_read_ok, rows_dated, rows_corrupt),
    counted by the conditions that route the rows, while the lake table is
    written.  The raw files are read once; a second time only when they hold bad
    rows, for the quarantine.

    Lake rows, quarantine rows and ledger rows of a run are one commit
    (:mod:`basalt.sinks.commits`): a run that dies at any point and is started again
    gives every row once.  :func:`read_lake` reads with the same guarantee.

    With ``ledger_root`` (T6, T7) the files are listed and those the ledger has
    settled are not read at all; the rest is ingested by ``max_files`` at a time, each
    such batch a commit of its own.  A batch that fails is halved until the file at
    fault stands alone, which is tried up to ``max_attempts`` times; every such
    attempt is a ledger row.  A file that cannot be read is then set aside in the
    quarantine.  When a readable file cannot be written, the fault is not the file's: the rest
    of the batch is committed, the file stays unsettled and the error is raised.

    With ``replace_changed`` the lake rows carry their file (``SOURCE_COLUMN``), and a file that was
    written again since it was ingested is ingested again in place of its earlier rows: the lake files
    that hold such rows are written anew without them, and the old ones go by the same
    commit.
    """
    log_root = ledger_root or out_root
    recover(spark, log_root)
    if replace_changed and ledger_root is None:
        raise ValueError("changed files are known by the ledger")

    def stage(run: StagedRun, files) -> tuple[int, int, int]:
        return _stage_batch(run, spark, files, out_root, quarantine_root, schema, date_field, partition_by_date, replace_changed)

    if ledger_root is None:
        run = StagedRun(spark, log_root)
        try:
            counts = stage(run, paths)
        except Exception:
            run.discard()
            raise
        run.commit()
        return _summary_row(spark, None, counts)
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(ledger_root)  # the folder exists from here on
    ledger = read_ledger(spark, ledger_root)
    new = written(unprocessed(_listed(spark, paths), ledger, replace_changed).select("path", "stamp"), "pending")
    totals, read = (0, 0, 0), 0
    for batch in _in_batches(new, max_files):
        run, log, stamps = StagedRun(spark, log_root), [], dict(batch)
        done, n, error = _with_retries([f for f, _ in batch], lambda f, run=run: stage(run, f),
                                       lambda f: _readable(spark, f, schema), max_attempts, log)
        if replace_changed:
            again = [f for f, _, status in log if status == DONE]
            _stage_replaced(run, spark, again, ledger, out_root, SOURCE_COLUMN)
            if quarantine_root is not None:
                _stage_replaced(run, spark, again, ledger, quarantine_root, "file")
        _stage_log(run, spark, log, ledger_root, quarantine_root, stamps)
        run.commit()
        if error is not None:
            raise error
        totals, read = tuple(a + b for a, b in zip(totals, done, strict=True)), read + n
    return _summary_row(spark, read, totals)


#: The file that a lake row came from, where files can be replaced.
SOURCE_COLUMN = "source_file"


def _stage_replaced(run: StagedRun, spark: SparkSession, files: list[str], ledger: DataFrame, root: str, column: str) -> None:
    """Stage the table files that hold rows of ``files`` from an earlier run again without those rows.

    The names are those of one batch; only table files that hold such rows are read whole."""
    named = spark.createDataFrame([(f,) for f in files], "path string").select(file_name("path").alias("_f"))
    earlier = named.join(ledger.where(F.col("status") == DONE).select(F.col("file").alias("_f")).distinct(), "_f", "left_semi")
    if not files_below(spark, root) or earlier.isEmpty():
        return
    table = spark.read.option("mergeSchema", True).parquet(root)
    if column not in table.columns:
        return
    ours = file_name(column) == F.col("_f")
    holding = [r["p"] for r in table.join(F.broadcast(earlier), ours, "left_semi")  # at most the names of one batch
               .select(F.col("_metadata.file_path").alias("p")).distinct().collect()]
    if not holding:
        return
    part = run.folder(root)
    rest = spark.read.schema(table.schema).option("basePath", root).parquet(*holding).join(F.broadcast(earlier), ours, "left_anti")
    by = [c for c in PARTITION_COLUMNS if c in table.columns and f"/{c}=" in holding[0]]
    (rest.write.partitionBy(*by) if by else rest.write).parquet(part)
    run.add(root, part)
    run.replace(holding)


def read_lake(spark: SparkSession, out_root: str, ledger_root: str | None = None) -> DataFrame:
    """The lake table with every committed run in place and no other."""
    recover(spark, ledger_root or out_root)
    return spark.read.parquet(out_root)


def _listed(spark: SparkSession, paths) -> DataFrame:
    """Files to ingest (``path``, ``stamp``): a list of files as it is, folders by listing them with time and size."""
    if isinstance(paths, str):
        stamp = F.concat_ws(":", F.unix_micros("modificationTime"), "length")
        return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", stamp.alias("stamp")))
    return spark.createDataFrame([(x, None) for x in paths], "path string, stamp string")


def _in_batches(files: DataFrame, size: int) -> Iterator[list[tuple[str, str | None]]]:
    """Names of at most ``size`` files at a time; the driver fetches one partition of names after the other."""
    batch: list[tuple[str, str | None]] = []
    for row in files.toLocalIterator():
        batch.append((row["path"], row["stamp"]))
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch


def _readable(spark: SparkSession, file: str, schema: T.StructType | None) -> bool:
    try:
        read_jsonl(spark, [file], schema=schema).write.format("noop").mode("overwrite").save()
    except Exception:  # noqa: BLE001 - any reason that a file cannot be read
        return False
    return True


def _with_retries(files: list[str], stage: Callable, readable: Callable, max_attempts: int, log: list,
                  ) -> tuple[tuple[int, int, int], int, Exception | None]:
    """All files at once; a failing batch in halves, a single file up to ``max_attempts`` times.

    Returns the counts, the files read, and the error of a file that can be read but not written."""
    if len(files) > 1:
        try:
            done = stage(files)
            log += [(f, 1, DONE) for f in files]
            return done, len(files), None
        except Exception:  # noqa: BLE001 - any reason that a batch cannot be read or written
            middle = len(files) // 2
            one = _with_retries(files[:middle], stage, readable, max_attempts, log)
            two = _with_retries(files[middle:], stage, readable, max_attempts, log)
            return tuple(a + b for a, b in zip(one[0], two[0], strict=True)), one[1] + two[1], one[2] or two[2]
    (file,) = files
    for attempt in range(1, max_attempts + 1):
        try:
            done = stage([file])
        except Exception as exc:  # noqa: BLE001
            last = attempt == max_attempts
            aside = last and not readable(file)
            log.append((file, attempt, SET_ASIDE if aside else FAILED))
            if last:
                return (0, 0, 0), 0, None if aside else exc
        else:
            log.append((file, attempt, DONE))
            return done, 1, None
    raise ValueError("max_attempts is less than 1")


def _stage_batch(run: StagedRun, spark, files, out_root, quarantine_root, schema, date_field,
                 partition_by_date, with_source: bool = False) -> tuple[int, int, int]:
    """Stage the lake rows and, if there are any, the bad ones: (good, dated, bad) rows."""
    df = read_jsonl(spark, files, schema=schema)
    bad = is_bad(df, date_field)
    dated = F.count_if(~bad & F.col(date_field).isNotNull()) if date_field in df.columns else F.count_if(~bad)
    counts = [F.count_if(~bad).alias("good"), dated.alias("dated"), F.count_if(bad).alias("bad")]
    obs = Observation()
    good_rows = split_good_bad(df.observe(obs, *counts), date_field)[0]
    good_rows = good_rows.withColumn(SOURCE_COLUMN, file_name("_file")).drop("_file") if with_source else good_rows.drop("_file")
    lake = transform_for_lake(good_rows, date_field, partition_by_date)
    lake_part = run.folder(out_root)
    if partition_by_date and date_field in lake.columns:
        lake.hint("rebalance", *PARTITION_COLUMNS).write.partitionBy(*PARTITION_COLUMNS) \
            .option("compression", "snappy").parquet(lake_part)
    else:
        lake.write.parquet(lake_part)
    # without an observation no row reached the lake: all are bad, or there are none
    m = observed(obs) or df.agg(*counts).first().asDict()
    good, n_dated, n_bad = (int(m[k] or 0) for k in ("good", "dated", "bad"))
    parts = [(out_root, lake_part)]
    if n_bad and quarantine_root is not None:
        bad_part = run.folder(quarantine_root)
        quarantine_rows(split_good_bad(df, date_field)[1]).write.parquet(bad_part)
        parts.append((quarantine_root, bad_part))
    for part in parts:
        run.add(*part)
    return good, n_dated, n_bad


def _stage_log(run: StagedRun, spark: SparkSession, log: list, ledger_root: str, quarantine_root: str | None,
               stamps: dict[str, str | None] | None = None) -> None:
    """Stage the ledger rows of a batch and, in the quarantine, the files set aside."""
    rows = spark.createDataFrame([(*row, (stamps or {}).get(row[0])) for row in log], LEDGER_SCHEMA).withColumn("file", file_name("file")).coalesce(1)
    if quarantine_root is not None and any(status == SET_ASIDE for _, _, status in log):
        aside = run.folder(quarantine_root)
        rows.where(F.col("status") == SET_ASIDE).select(
            "file", F.lit(None).cast("string").alias("raw"), F.lit("unreadable").alias("reason"),
            F.col("attempt").alias("attempts")).write.parquet(aside)
        run.add(quarantine_root, aside)
    part = run.folder(ledger_root)
    rows.write.parquet(part)
    run.add(ledger_root, part)


def _summary_row(spark: SparkSession, files: int | None, counts: tuple[int, int, int]) -> DataFrame:
    return spark.createDataFrame([(files, *counts)],
                                 "files_read bigint, rows_read_ok bigint, rows_dated bigint, rows_corrupt bigint")


def processing_time(start, end) -> Column:
    """Seconds between two timestamps (fractional)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return (F.unix_micros(e.cast("timestamp")) - F.unix_micros(s.cast("timestamp"))) / F.lit(1e6)
