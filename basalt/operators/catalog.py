"""Catalog: databases, Parquet table registration, discovery.

DDL runs on the driver (it is metadata), but every piece of information it
needs comes from Spark: schemas from Parquet footers, partitions from
``MSCK REPAIR TABLE``, table folders from a listing of one level.  Tables are
registered with the types of their files, so every column can be read back;
the five lake types (C6) are what schemas show.
"""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.sinks.writers import PARTITION_COLUMNS


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> bool:
    """Create the database when absent; True when it exists afterwards."""
    loc = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)}{loc}")
    return spark.catalog.databaseExists(database)


# C6 fixed values: the five table types of the lake.
LAKE_TYPES = ["bigint", "double", "boolean", "timestamp", "string"]


def lake_type(dtype: T.DataType) -> str:
    """Any integer -> bigint, any float -> double, bool -> boolean,
    date-time -> timestamp, everything else -> string."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return "string"


def lake_columns(schema: T.StructType, exclude: tuple = ()) -> list[tuple[str, str]]:
    """(name, lake type) for every column of a schema."""
    return [(f.name, lake_type(f.dataType)) for f in schema.fields if f.name not in exclude]


def file_columns(schema: T.StructType, exclude: tuple = ()) -> list[tuple[str, str]]:
    """(name, type as stored) for every column of a file schema."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name not in exclude]


def conform(df: DataFrame) -> DataFrame:
    """C6 applied to data: cast each column to its lake type (complex types -> JSON text)."""
    out = []
    for f in df.schema.fields:
        t = lake_type(f.dataType)
        c = F.col(_q(f.name))
        if t == "string" and isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        out.append(c.cast(t).alias(f.name))
    return df.select(*out)


def register_parquet_table(spark: SparkSession, database: str, table: str, location: str,
                           columns: list[tuple[str, str]], partition_keys: list[str] | tuple = (),
                           repair: bool = True) -> bool:
    """External Parquet table (``USING PARQUET``, D3); no error if it exists.

    Partition keys are strings; ``MSCK REPAIR TABLE`` then loads the partitions
    that are already on storage.
    """
    cols = [f"{_q(n)} {t}" for n, t in columns if n not in partition_keys]
    cols += [f"{_q(p)} string" for p in partition_keys]
    part = f" PARTITIONED BY ({', '.join(_q(p) for p in partition_keys)})" if partition_keys else ""
    full = f"{_q(database)}.{_q(table)}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({', '.join(cols)}) USING PARQUET{part} LOCATION {_text(location)}")
    if partition_keys and repair:
        spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
    return spark.catalog.tableExists(f"{database}.{table}")


def table_location(path: str) -> str:
    """C4: the folder of a file key, cut before the first ``k=v`` element."""
    parts = path.split("/")[:-1]
    for i, p in enumerate(parts):
        if "=" in p:
            parts = parts[:i]
            break
    return "/".join(parts) + "/"


def table_location_col(path) -> Column:
    """C4 as a Column expression, for listings of many files."""
    c = F.col(path) if isinstance(path, str) else path
    folder = F.regexp_replace(c, r"[^/]*$", "")
    return F.regexp_replace(folder, r"/[^/=]+=.*$", "/")


def partition_keys_of(path: str) -> list[str]:
    """Partition names found in a key (``year=2024/month=01`` -> year, month)."""
    return re.findall(r"([^/=]+)=", path.rsplit("/", 1)[0] + "/") if "=" in path else []


def partition_keys_col(path) -> Column:
    """C5 as a Column expression."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract_all(F.regexp_replace(c, r"[^/]*$", ""), F.lit(r"([^/=]+)="), 1)


def auto_register(spark: SparkSession, database: str, table: str, file_path: str) -> bool:
    """Register a table from one existing Parquet file (schema from its footer, D2)."""
    schema = spark.read.parquet(file_path).schema
    keys = partition_keys_of(file_path)
    location = table_location(file_path)
    cols = file_columns(schema, exclude=tuple(keys))
    return register_parquet_table(spark, database, table, location, cols, keys)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Table names of a database, without the views of this session."""
    return spark.sql(f"SHOW TABLES IN {_q(database)}").where(~F.col("isTemporary")).select(F.col("tableName").alias("table"))


def table_schema(spark: SparkSession, database: str, table: str) -> DataFrame:
    """(column, lake type, is_partition) of a table."""
    schema = spark.table(f"{_q(database)}.{_q(table)}").schema
    keys = {c.name for c in spark.catalog.listColumns(f"{database}.{table}") if c.isPartition}
    rows = [(f.name, lake_type(f.dataType), f.name in keys) for f in schema.fields]
    return spark.createDataFrame(rows, "column string, type string, is_partition boolean")


def tables_detail(spark: SparkSession, database: str) -> DataFrame:
    """Every table with its column count and location."""
    rows = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary:  # session views are listed with every database
            continue
        n_cols = len(spark.catalog.listColumns(f"{database}.{t.name}"))
        desc = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(database)}.{_q(t.name)}")
        loc = desc.where(F.col("col_name") == "Location").select("data_type").first()
        rows.append((t.name, n_cols, loc[0] if loc else None))
    return spark.createDataFrame(rows, "table string, columns int, location string")


def _level(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of the entries of one folder, hidden ones left out."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    entries = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    found = [(e.getPath().getName(), e.isDirectory()) for e in entries]
    return sorted(x for x in found if not x[0].startswith(("_", ".")))


def _layouts(spark: SparkSession, path: str) -> list[list[str]]:
    """The distinct partition keys of all Parquet files below a table folder (none: no files)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(path).select(partition_keys_col("path").alias("keys")))
    return sorted(r["keys"] for r in files.distinct().collect())  # one row per layout


#: Types that every Parquet reader of this engine widens, from narrow to wide.
_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def widen(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that reads files of both types by value; None when there is none.

    Whole numbers widen to larger ones, up to 32 bits also to double; float to double; dates to
    timestamps without zone; decimals to the digits of both; structs, arrays and maps
    by their parts, with the fields of both.
    """
    if old == new:
        return old
    if old in _WHOLE and new in _WHOLE:
        return max(old, new, key=_WHOLE.index)
    pair = {type(old), type(new)}
    if T.DoubleType in pair and pair & {T.FloatType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if pair == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if pair == {T.DecimalType}:
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if pair == {T.ArrayType}:
        inner = widen(old.elementType, new.elementType)
        return None if inner is None else T.ArrayType(inner, True)
    if pair == {T.MapType}:
        key, value = widen(old.keyType, new.keyType), widen(old.valueType, new.valueType)
        return None if key is None or value is None else T.MapType(key, value, True)
    if pair == {T.StructType}:
        merged, refused = merge_schemas(old, new)
        return None if refused else merged
    return None


def merge_schemas(old: T.StructType, new: T.StructType) -> tuple[T.StructType, dict[str, str]]:
    """The columns of both, wide enough for both (those of ``old`` first), and by name those
    that cannot be read together.  Names are compared without case, as the engine does."""
    theirs = {f.name.lower(): f for f in new.fields}
    fields, refused = [], {}
    for f in old.fields:
        other = theirs.pop(f.name.lower(), None)
        dtype = f.dataType if other is None else widen(f.dataType, other.dataType)
        if dtype is None:
            refused[f.name.lower()] = f"{f.name}: " + " and ".join(sorted(t.dataType.simpleString() for t in (f, other)))
        fields.append(T.StructField(f.name, dtype or f.dataType, True))
    fields += [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name.lower() in theirs]
    return T.StructType(fields), refused


def files_schema(spark: SparkSession, paths: list[str], keys: list[str] | tuple = (), since: str | None = None,
                 ) -> tuple[T.StructType, dict[str, str]]:
    """Schema of Parquet files or folders from all their footers (read in one job), and refusals.

    Files whose types differ cannot be merged by the reader itself: then their
    list is halved until each part can, and the parts are merged by :func:`merge_schemas`.
    ``since`` (ISO time) leaves out files that were not modified after it.
    """
    reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
    if since is not None:
        reader = reader.option("modifiedAfter", since)
    try:
        found = reader.parquet(*paths).schema
    except AnalysisException as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc.getCondition() or exc):
            return T.StructType([]), {}
        raise
    except (PySparkException, Py4JJavaError):
        if len(paths) == 1:
            index = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
            if since is not None:
                index = index.option("modifiedAfter", since)
            files = sorted(r["path"] for r in index.load(paths[0]).select("path").collect())
            if files == paths or len(files) < 2:
                raise
            paths = files
        middle = len(paths) // 2
        one, refused_one = files_schema(spark, paths[:middle], keys, since)
        two, refused_two = files_schema(spark, paths[middle:], keys, since)
        merged, refused = merge_schemas(one, two)
        return merged, refused_one | refused_two | refused
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in found.fields if f.name not in keys]), {}


def follow_files(spark: SparkSession, database: str, table: str, location: str, keys: list[str],
                 since: str | None = None) -> tuple[str, str | None]:
    """Bring a known table up to its files: (action, detail).

    New columns are added (``ALTER TABLE ADD COLUMNS``); columns that became wider make
    the external table anew with the wider types, its files untouched; a change that no
    type can read leaves the table as it is (``refused``).  Columns that newer files
    lack stay and read as null.
    """
    full = f"{_q(database)}.{_q(table)}"
    known = spark.table(full).schema
    own = T.StructType([f for f in known.fields if f.name not in keys])
    have = [c.name for c in spark.catalog.listColumns(f"{database}.{table}") if c.isPartition]
    if have != list(keys):
        return "refused", f"partitioned by {', '.join(have) or 'nothing'}, files by {', '.join(keys) or 'nothing'}"
    files, refused = files_schema(spark, [location], keys, since)
    merged, more = merge_schemas(own, files)
    if refused or more:
        return "refused", "; ".join((refused | more).values())
    added = merged.fields[len(own.fields):]
    widened = [f.name for f, g in zip(own.fields, merged.fields, strict=False) if f.dataType != g.dataType]
    if widened:
        spark.sql(f"DROP TABLE {full}")  # external: the files stay
        register_parquet_table(spark, database, table, location, file_columns(merged), keys)
    elif added:
        spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(f'{_q(f.name)} {f.dataType.simpleString()}' for f in added)})")
    if keys and not widened:
        spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
    spark.catalog.refreshTable(f"{database}.{table}")
    notes = [f"added {', '.join(f.name for f in added)}"] * bool(added) + [f"widened {', '.join(widened)}"] * bool(widened)
    return ("altered", "; ".join(notes)) if notes else ("updated", None)


def _plain(location: str | None) -> str:
    return re.sub(r"/+", "/", re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", location or "")).rstrip("/")


def discover_tables(spark: SparkSession, database: str, root: str, drop_missing: bool = True,
                    since: str | None = None) -> DataFrame:
    """One table per first-level folder under ``root`` that holds Parquet files (crawler).

    New tables are created with the schema of their files; known ones follow their files
    (:func:`follow_files`, their footers compared with the catalog; ``since`` limits
    that to files modified after it); tables under this root whose folder is
    gone are dropped; tables elsewhere are left alone.  A folder whose files are not all
    partitioned alike, or hold types that cannot be read together, is refused.
    Returns (table, action, detail) rows.
    """
    create_database(spark, database)
    base = root.rstrip("/")
    actions = []
    found = set()
    for folder, is_folder in _level(spark, base):  # one entry per table folder
        layouts = _layouts(spark, f"{base}/{folder}") if is_folder else []
        if not layouts:
            continue
        name = re.sub(r"[^A-Za-z0-9_]", "_", folder).lower()
        found.add(name)
        location = f"{base}/{folder}"
        if len(layouts) > 1:
            detail = " and ".join(", ".join(keys) or "nothing" for keys in layouts)
            actions.append((name, "refused", f"files partitioned by {detail}"))
            continue
        (keys,) = layouts
        if spark.catalog.tableExists(f"{database}.{name}"):
            actions.append((name, *follow_files(spark, database, name, location, keys, since)))
            continue
        schema, refused = files_schema(spark, [location], keys)
        if refused:
            actions.append((name, "refused", "; ".join(refused.values())))
            continue
        register_parquet_table(spark, database, name, location, file_columns(schema), keys)
        actions.append((name, "created", None))
    if drop_missing:
        below = _plain(base) + "/"
        for row in tables_detail(spark, database).collect():  # one row per table
            if row["table"] not in found and _plain(row["location"]).startswith(below):
                spark.sql(f"DROP TABLE IF EXISTS {_q(database)}.{_q(row['table'])}")
                actions.append((row["table"], "dropped", None))
    return spark.createDataFrame(actions, "table string, action string, detail string")


__all__ = ["PARTITION_COLUMNS", "auto_register", "conform", "create_database", "discover_tables",
           "file_columns", "files_schema", "follow_files", "lake_columns", "lake_type", "list_tables", "merge_schemas", "partition_keys_col", "partition_keys_of",
           "register_parquet_table", "table_location", "table_location_col", "table_schema",
           "tables_detail", "widen"]
