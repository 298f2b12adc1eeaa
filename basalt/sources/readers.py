"""Readers for the raw zone.

All readers are lazy ``DataFrameReader`` calls: the files are split into
tasks by Spark (``spark.sql.files.maxPartitionBytes``), nothing passes
through the driver, and only the selected columns are read.  Whole files (S6)
of a local folder are listed and read by tasks without Spark's file index.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.session import local_path, written

CORRUPT = "_corrupt"

# Raw event line of the ingest path: ISO-8601 time text, user, action.
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("action", T.StringType()),
])


def with_corrupt(schema: T.StructType, name: str = CORRUPT) -> T.StructType:
    if name in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(name, T.StringType())])


MICROS_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_jsonl(spark: SparkSession, path, schema: T.StructType | None = None,
               corrupt_column: str = CORRUPT, lineage: bool = True, options: dict | None = None) -> DataFrame:
    """One JSON object per line; bad lines kept in ``corrupt_column``.

    With an explicit schema no inference pass runs over the data.  ``lineage``
    adds ``_file`` (full path) from the hidden ``_metadata`` column.
    """
    reader = (spark.read.option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt_column).options(**(options or {})))
    if schema is not None:
        reader = reader.schema(with_corrupt(schema, corrupt_column))
    df = reader.json(path)
    if corrupt_column not in df.columns:
        df = df.withColumn(corrupt_column, F.lit(None).cast("string"))
    if lineage:
        df = df.withColumn("_file", F.col("_metadata.file_path"))
    return df


def read_json_document(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON array of objects or a single object per file."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """S3: nested structs become dotted top-level columns; arrays are kept as they are."""
    cols = []

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name])
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))

    for f in df.schema.fields:
        walk(f.dataType, [f.name])
    return df.select(*cols)


# CSV dialect of readers and writers: quotes inside a value are doubled, blanks are kept.
CSV_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None, header: bool = True,
             multi_line: bool = True, corrupt_column: str | None = None) -> DataFrame:
    """CSV with a header line; inference only when no schema is given.

    Doubled quotes and line breaks inside quotes are read as part of the value.
    ``multi_line=False`` lets Spark split large files that hold no line break in
    a value.  With a schema, ``corrupt_column`` keeps the text of rows that do
    not fit it."""
    # a missing value is an empty field without quotes; "" in quotes is an empty text
    reader = (spark.read.options(**CSV_DIALECT).option("header", header).option("multiLine", multi_line)
              .option("nullValue", "\u0000"))
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if corrupt_column:
        schema = with_corrupt(schema, corrupt_column)
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def read_parquet(spark: SparkSession, path, nanos_columns: list[str] | tuple = (),
                 merge_schema: bool = False) -> DataFrame:
    """Parquet; ``nanos_columns`` (epoch-ns longs from pandas) become timestamps."""
    df = spark.read.option("mergeSchema", merge_schema).parquet(path)
    for c in nanos_columns:
        if c in df.columns and isinstance(df.schema[c].dataType, T.LongType):
            df = df.withColumn(c, F.timestamp_micros(F.expr(f"`{c}` div 1000")))
    return df


#: What opening a file counts as besides its bytes, file names handed over at once, and bytes of files handed over at once.
OPEN_BYTES, LIST_ROWS, BATCH_BYTES = 4096, 10_000, 8 << 20


def _whole_files(spark: SparkSession, path, recursive: bool) -> DataFrame:
    """path, length, modificationTime, content of every file that is not empty, as ``binaryFile`` has them.

    Spark's index keeps all names on the driver and its scan puts a few dozen files into a task, however
    small they are.  Below a local folder tasks list the folders, the list is written, and its files are dealt
    to tasks by their number and bytes.  Other stores and patterns go through ``binaryFile``."""
    root = local_path(spark, path) if recursive and isinstance(path, str) and not set(path) & set("*?[]{}\\") else None
    if root is None or not os.path.isdir(root):
        return (spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
                .select("path", "length", "modificationTime", "content"))
    listed = written(_list_files(spark, root), "file-list")
    n, size = listed.agg(F.count("path"), F.coalesce(F.sum("length"), F.lit(0))).first()
    at_once = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(ceil((size + n * OPEN_BYTES) / at_once), min(n, spark.sparkContext.defaultParallelism), 1)
    most = BATCH_BYTES

    def run(batches):
        import os
        import zlib

        import pyarrow as pa

        def verify(path: str, content: bytes) -> None:
            """Against the checksums that Hadoop's local writers leave beside a file."""
            folder, name = os.path.split(path)
            try:
                with open(f"{folder}/.{name}.crc", "rb") as f:
                    kept = f.read()
            except FileNotFoundError:
                return
            if kept[:4] != b"crc\0":
                return
            step, view = int.from_bytes(kept[4:8], "big"), memoryview(content)
            if kept[8:] != b"".join(zlib.crc32(view[i:i + step]).to_bytes(4, "big") for i in range(0, len(view), step)):
                raise OSError(f"checksum error: {path}")

        def batch_of(rows):
            path, length, ms, content = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(length, pa.int64()), pa.array(ms, pa.int64()),
                                               pa.array(content, pa.binary())], names=["path", "length", "ms", "content"])

        for batch in batches:
            rows, held = [], 0
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as f:
                    content, status = f.read(), os.fstat(f.fileno())
                verify(path, content)
                rows.append((f"file:{path}", len(content), status.st_mtime_ns // 1_000_000, content))
                held += len(content)
                if held >= most:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    files = listed.select("path").repartition(tasks, "path").mapInArrow(run, "path string, length long, ms long, content binary")
    return files.select("path", "length", F.timestamp_millis("ms").alias("modificationTime"), "content")


def _list_files(spark: SparkSession, root: str) -> DataFrame:
    """path, length of the files below a local folder that Spark's readers would see; each of its folders is listed by a task."""
    at_once = LIST_ROWS

    def hidden(name: str, is_folder: bool) -> bool:  # as Spark's listing has it
        return (name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name
                and not (is_folder and name.startswith(("_metadata", "_common_metadata"))))

    def entries(folder: str) -> Iterator[os.DirEntry]:
        with os.scandir(folder) as found:
            yield from (e for e in found if not hidden(e.name, e.is_dir()))

    def run(batches):
        import pyarrow as pa

        def batch_of(rows):
            path, length = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(length, pa.int64())], names=["path", "length"])

        rows = []
        for batch in batches:
            for top, deep in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pending = [top]
                while pending:
                    for e in entries(pending.pop()):
                        if e.is_dir():
                            if deep:
                                pending.append(e.path)
                        elif e.is_file() and (size := e.stat().st_size):
                            rows.append((e.path, size))
                            if len(rows) == at_once:
                                yield batch_of(rows)
                                rows = []
        if rows:
            yield batch_of(rows)

    tops = [(root, False), *((e.path, True) for e in entries(root) if e.is_dir())]
    return spark.createDataFrame(tops, "folder string, deep boolean").mapInArrow(run, "path string, length long")


def read_text_files(spark: SparkSession, path, preview_chars: int | None = None, hex_bytes: int | None = None,
                    recursive: bool = True) -> DataFrame:
    """One row per file: byte length, encoding used, text or hex dump, whole
    unless ``preview_chars`` / ``hex_bytes`` limit what is shown.

    UTF-8 first, then latin-1 (D13: latin-1 accepts any byte, so it is the last
    text option); files with NUL bytes are shown as hex of their first bytes.
    """
    raw = _whole_files(spark, path, recursive)
    as_text = F.col("content").cast("string")
    encoding = (F.when(F.instr(as_text, "\x00") > 0, F.lit("binary"))
                .when(F.is_valid_utf8(as_text), F.lit("utf-8"))
                .otherwise(F.lit("latin-1")))
    text = (F.when(encoding == "utf-8", as_text)
            .when(encoding == "latin-1", F.decode("content", "ISO-8859-1")))
    return raw.select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        encoding.alias("encoding"),
        (text if preview_chars is None else F.substring(text, 1, preview_chars)).alias("preview"),
        F.when(encoding == "binary", F.lower(F.hex(
            F.col("content") if hex_bytes is None else F.substring("content", 1, hex_bytes)))).alias("hex_head"),
    )


FORMATS = {"parquet": "parquet", "json": "json", "jsonl": "jsonl", "csv": "csv",
           "txt": "text", "log": "text", "metadata": "text"}


def read_dataset(spark: SparkSession, path: str, fmt: str | None = None, **kw) -> DataFrame:
    """Pick the reader from ``fmt`` or the file extension; unknown -> ValueError."""
    kind = (fmt or path.rstrip("/").rsplit(".", 1)[-1]).lower()
    if kind not in FORMATS:
        raise ValueError(f"unsupported file type: {kind}")
    kind = FORMATS[kind]
    if kind == "parquet":
        return read_parquet(spark, path, **kw)
    if kind == "jsonl":
        return read_jsonl(spark, path, **kw)
    if kind == "json":
        return read_json_document(spark, path, **kw)
    if kind == "csv":
        return read_csv(spark, path, **kw)
    return spark.read.text(path)


def read_logs(spark: SparkSession, path) -> DataFrame:
    """Log files as lines with their file."""
    return (spark.read.text(path)
            .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")))
