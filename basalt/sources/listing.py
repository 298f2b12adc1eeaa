"""Object manifests from the file system (S8) and partition-path scans.

A listing is Spark's own parallel file listing through the ``binaryFile``
source with only ``path, length, modificationTime`` selected: the file
contents are never read.  There is no page limit (D6): every file under
the root is listed.

Spark's file index keeps the names of one read on the driver.  For stores too
large for that, :func:`write_listing` lists group after group of folders and
writes each group's rows, so the driver holds one group at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import batched
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_COLUMNS = ["bucket", "key", "size", "modified", "source"]


def list_files(spark: SparkSession, root: str, source: str, prefix: str = "") -> DataFrame:
    """Manifest rows (bucket, key, size, modified, source) under ``root/prefix``.

    ``bucket`` is the root folder and ``key`` the path below it, as in an object store.
    """
    base = root.rstrip("/")
    target = f"{base}/{prefix}" if prefix else base
    return _manifest(_index(spark, [target]), base, source)


def _index(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files below ``paths`` from Spark's parallel listing.  A scan passes over empty files; their names
    are in its index all the same, and their times are asked for one by one."""
    scan = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
            .select("path", "length", "modificationTime"))
    names = scan.inputFiles()
    if len(names) == scan.count():
        return scan
    indexed = spark.createDataFrame([(unquote(n),) for n in names], "name string")
    empty = indexed.join(scan.select("path"), _plain_path("name") == _plain_path("path"), "left_anti").collect()
    rows = []
    for r in empty:
        path = spark._jvm.org.apache.hadoop.fs.Path(r["name"])
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        rows.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return scan.unionByName(_rows(spark, rows))


def _rows(spark: SparkSession, rows) -> DataFrame:
    made = spark.createDataFrame(rows, "path string, length long, ms long")
    return made.select("path", "length", F.timestamp_millis("ms").alias("modificationTime"))


def _plain_path(column: str) -> Column:
    """A path without its scheme and with single slashes."""
    return F.regexp_replace(F.regexp_replace(column, r"^[A-Za-z][A-Za-z0-9+.-]*:", ""), "/+", "/")


def _manifest(files: DataFrame, base: str, source: str) -> DataFrame:
    # keys are taken relative to the root, whatever scheme the path carries
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _escape(base.split(":", 1)[-1].lstrip("/")) + "/", "")
    return files.select(F.lit(base).alias("bucket"), rel.alias("key"), F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"), F.lit(source).alias("source"))


#: Folders of one group, and file rows of the upper levels handed over at once.
GROUP_FOLDERS, GROUP_FILES = 64, 10_000
FILE_SCHEMA = "path string, length long, modificationTime timestamp"


def _walk(spark: SparkSession, root: str, depth: int) -> Iterator[tuple[str, int, int, bool]]:
    """(path, size, time in ms, is a folder) of the files of the upper ``depth`` levels and the folders below
    them; an iterator over the store's pages, hidden names left out."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    pending = [(top, 1)]
    while pending:
        folder, level = pending.pop()
        entries = fs.listStatusIterator(folder)
        while entries.hasNext():
            e = entries.next()
            if e.getPath().getName().startswith(("_", ".")):
                continue
            if e.isDirectory() and level < depth:
                pending.append((e.getPath(), level + 1))
            else:
                yield e.getPath().toString(), e.getLen(), e.getModificationTime(), e.isDirectory()


def _literal(path: str) -> str:
    """A path as a reader's argument: characters that would be a pattern stand for themselves."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def write_listing(spark: SparkSession, root: str, out: str, depth: int = 1, group_folders: int = GROUP_FOLDERS) -> DataFrame:
    """S8 without one process that holds all names: the files below ``root`` (path, length, modificationTime) as a
    table at ``out``.

    The folders at ``depth`` are listed ``group_folders`` at a time by Spark's parallel listing and written; the
    driver keeps one group of names (and the folders of the upper levels while it walks
    them).  Choose ``depth`` so that a group fits, such as 3 for year / month / day.
    :func:`list_written` reads the result as a manifest."""
    spark.createDataFrame([], FILE_SCHEMA).write.mode("append").parquet(out)
    folders: list[str] = []
    files: list[tuple[str, int, int]] = []

    def flush_folders() -> None:
        if folders:
            _index(spark, [_literal(f) for f in folders]).write.mode("append").parquet(out)
            folders.clear()

    def flush_files() -> None:
        for part in batched(files, GROUP_FILES):
            _rows(spark, part).write.mode("append").parquet(out)
        files.clear()

    for path, size, ms, is_folder in _walk(spark, root, depth):
        if is_folder:
            folders.append(path)
            if len(folders) == group_folders:
                flush_folders()
        else:
            files.append((path, size, ms))
            if len(files) == GROUP_FILES:
                flush_files()
    flush_folders()
    flush_files()
    return spark.read.schema(FILE_SCHEMA).parquet(out)


def list_written(listing: DataFrame, root: str, source: str) -> DataFrame:
    """The manifest rows of a listing that :func:`write_listing` made of ``root``."""
    return _manifest(listing, root.rstrip("/"), source)


def list_lake(spark: SparkSession, raw_root: str, processed_root: str) -> DataFrame:
    """S8 + F17: raw and processed listings in one manifest."""
    return list_files(spark, raw_root, "raw").unionByName(list_files(spark, processed_root, "processed"))


def list_store(spark: SparkSession, raw_root: str, processed_root: str, processed_prefix: str) -> DataFrame:
    """S8 + F17 with one source per file.

    The raw store is listed whole and the processed store below
    ``processed_prefix``.  When both are the same root (one bucket for both,
    as in the shipped settings) the root is listed once and a file is
    ``processed`` when its key starts with ``processed_prefix``, else ``raw``;
    listing it twice would count every processed file under both sources."""
    if raw_root.rstrip("/") != processed_root.rstrip("/"):
        return list_files(spark, raw_root, "raw").unionByName(
            list_files(spark, processed_root, "processed", processed_prefix))
    one = list_files(spark, raw_root, "raw")
    src = F.when(F.col("key").startswith(processed_prefix), F.lit("processed")).otherwise(F.lit("raw"))
    return one.withColumn("source", src)


def _escape(text: str) -> str:
    out = []
    for ch in text:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch)
    return "".join(out)


def read_partition(spark: SparkSession, table_root: str, year: str | None = None,
                   month: str | None = None, day: str | None = None) -> DataFrame:
    """A ``year=/month=/day=`` table with partition pruning on the given parts."""
    df = spark.read.parquet(table_root)
    for name, value in (("year", year), ("month", month), ("day", day)):
        if value is not None:
            df = df.where(F.col(name) == F.lit(str(value)))
    return df
