"""Writers for the processed zone (K1-K6).

Each writer is one distributed ``DataFrameWriter`` job; nothing is gathered
on the driver.  Partitioned writes sort by partition columns inside each task
(Spark's dynamic partition writer), so a task keeps one open file at a time.
"""

from __future__ import annotations

import os
import shutil
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from basalt.session import local_path
from basalt.sources.readers import CSV_DIALECT

PARTITION_COLUMNS = ["year", "month", "day"]


def observed(obs: Observation) -> dict | None:
    """The values of an observation after its query ran; None when Spark dropped the node
    that observes, because the plan was empty or turned out empty at run time."""
    try:
        return obs.get
    except (AssertionError, Py4JJavaError, PySparkException):
        return None


def counting(df: DataFrame):
    """``df`` with its rows counted when it runs, and a function that gives the count
    afterwards (0 when the plan was or turned out empty)."""
    obs = Observation()
    watched = df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def rows() -> int:
        return int((observed(obs) or {}).get("rows", 0))
    return watched, rows


def write_parquet(df: DataFrame, path: str, mode: str = "append") -> bool:
    """K1: Parquet (snappy); an empty frame writes no rows and returns False.

    The rows are counted while they are written, so the input runs once."""
    counted, rows = counting(df)
    counted.write.mode(mode).option("compression", "snappy").parquet(path)
    return rows() > 0


def write_partitioned(df: DataFrame, path: str, columns: list[str] | None = None,
                      mode: str = "append") -> bool:
    """K2: ``year=YYYY/month=MM/day=DD`` layout, one partition per row's own date.

    Rows are clustered by the partition columns first (``rebalance`` hint), so
    each task writes few files; AQE splits a day that holds a large share of
    the rows over several tasks and merges small ones, instead of a plain hash
    repartition that would hand a hot day to a single task.
    """
    cols = columns or PARTITION_COLUMNS
    counted, rows = counting(df)
    (counted.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols)
     .option("compression", "snappy").parquet(path))
    return rows() > 0


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K3: CSV with a header line; quotes inside a value are doubled."""
    df.write.mode(mode).options(**CSV_DIALECT).option("header", True).csv(path)
    return path


TEXT_FOLDERS = 256  # folders of a store that only Spark reaches, each written by one task


def write_text_files(texts: DataFrame, path: str) -> None:
    """One text file per row of the only column, a line end after it, in a new folder ``path``.

    On a local file system Hadoop starts a process for the mode of every file and another for its checksum
    file; there each task writes plain files into a hidden folder of its own attempt, and the folders of the
    attempts that counted are moved into place when all have ended.  Other stores get the files from Spark's writer."""
    name = texts.columns[0]
    root = local_path(texts.sparkSession, path)
    if root is None:
        (texts.withColumn("folder", F.pmod(F.monotonically_increasing_id(), F.lit(TEXT_FOLDERS)))
         .repartition(TEXT_FOLDERS, "folder").write.partitionBy("folder").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path))
        return
    staging = f"{root}/_temporary"

    def run(batches):
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        part, n = f"part-{task.partitionId():05d}", 0
        folder = f"{staging}/{part}-{task.taskAttemptId()}"
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not n:
                    os.mkdir(folder)
                with open(f"{folder}/{n:08d}.txt", "xb") as f:
                    f.write((text or b"") + b"\n")
                n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"folder": [folder], "part": [part]})

    os.makedirs(root)
    os.mkdir(staging)
    try:
        for folder, part in texts.select(F.col(name).cast("binary")).mapInArrow(run, "folder string, part string").collect():
            os.rename(folder, f"{root}/{part}")
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def export_filtered_csv(full: DataFrame, filtered: DataFrame, path: str) -> str | None:
    """K4: export the filtered frame; None when the filter removed no row.

    The filter runs once: its rows are counted while they are written.  ``full``
    is only counted (from the footers of a Parquet scan)."""
    counted, rows = counting(filtered)
    write_csv(counted, path)
    return path if rows() < full.count() else None


def export_snapshot(snapshot: DataFrame, path: str, fmt: str = "json") -> str:
    """K5: a metrics snapshot as JSON lines or CSV."""
    if fmt == "json":
        snapshot.coalesce(1).write.mode("overwrite").json(path)
    elif fmt == "csv":
        snapshot.coalesce(1).write.mode("overwrite").options(**CSV_DIALECT).option("header", True).csv(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")
    return path


def save_result(df: DataFrame, result_root: str, run_id: str | None = None) -> str:
    """K6: keep a SQL result as CSV files under ``result_root/run_id``."""
    rid = run_id or uuid.uuid4().hex
    out = f"{result_root.rstrip('/')}/{rid}"
    df.write.mode("error").options(**CSV_DIALECT).option("header", True).csv(out)
    return out

