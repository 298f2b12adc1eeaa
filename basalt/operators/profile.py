"""Table profiling: column statistics, quality score, pattern detection.

Plan shape
----------
Per-column counts (rows, non-null, distinct) come from one unpivot of the
table into ``(column, value)`` followed by a single ``groupBy``.  Values keep
their type (a whole-number, a floating and a text slot), so 0.0 and -0.0 are
one value as in Spark itself; texts longer than ``LONG_TEXT`` bytes are keyed
by their SHA-256, so the shuffle never carries whole documents.  That is one
scan and one shuffle for all columns, with a map-side partial count: a value
that fills a third of a column is one row per task before it moves.

Top-k per column uses ``row_number() <= k``; Spark inserts a partial
``WindowGroupLimit`` before the shuffle, so at most k rows per column and
task are exchanged, whatever the column's cardinality.

``approx=True`` swaps exact distinct counts and quantiles for HLL++ and
``percentile_approx`` sketches (fixed-size state) when the caller asks for it.

NaN in float columns counts as null, as in pandas (``nanvl(c, NULL)``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# Fixed values that must equal the reference's rules -----------------------
TOP_VALUES = 5                 # P9: top values per text column
HIGH_CARD_RATIO = 0.95         # P13: distinct / rows above this ...
HIGH_CARD_MIN_ROWS = 100       # ... and more rows than this
CATEGORICAL_RATIO = 0.05       # P17: distinct / rows below this, distinct > 1
ID_MIN_ROWS = 10               # P18: rows above this
ID_NAMES = ["id", "uuid", "key"]
DATE_SHARE = 0.8               # P16: share that must parse
DUP_PENALTY_CAP = 20           # P14 penalties
EMPTY_COLUMN_PENALTY = 5
HIGH_CARD_PENALTY = 2
NULL_PENALTY_CAP = 30
LONG_TEXT = 64                 # P7: longer texts are counted by their digest
# Byte widths of fixed-size types for P2.
FIXED_WIDTH = {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4, "date": 4,
               "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
# ---------------------------------------------------------------------------


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC)


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_text(f.dataType)]


def columns_of_type(df: DataFrame, kind: str) -> DataFrame:
    """Only numeric or only text columns."""
    cols = {"numeric": numeric_columns, "text": text_columns}[kind](df)
    return df.select(*[_q(c) for c in cols])


def normalize(df: DataFrame) -> DataFrame:
    """NaN -> NULL in float columns (pandas counts NaN as missing)."""
    out = []
    for f in df.schema.fields:
        c = _q(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def _row_count(df: DataFrame) -> Column:
    return df.select(F.count(F.lit(1))).scalar()


def value_counts_long(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, value, n): one row per distinct value (NULL included) of each column."""
    cols = columns or df.columns
    norm = normalize(df.select(*[_q(c) for c in cols]))
    as_text = norm.select(*[_q(c).cast("string").alias(c) for c in cols])
    long = as_text.unpivot([], [_q(c) for c in cols], "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _dtypes(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "column string, dtype string, position int")


def _typed_slots(f: T.StructField) -> tuple[Column, Column, Column]:
    """A column's value in its (whole number, floating, text) slot; the others are null."""
    c, t = _q(f.name), f.dataType
    none = [F.lit(None).cast(x) for x in ("bigint", "double", "string")]
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("bigint"), none[1], none[2]
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("bigint"), none[1], none[2]
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")), none[1], none[2]
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return none[0], F.nanvl(c.cast("double"), none[1]), none[2]
    if isinstance(t, T.BinaryType):
        text = F.hex(c)
    elif isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
        text = F.when(c.isNotNull(), F.to_json(F.struct(c)))
    else:
        text = c.cast("string")
    # a digest is longer than any text that is kept as it is
    return none[0], none[1], F.when(F.octet_length(text) > LONG_TEXT, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def column_counts(df: DataFrame) -> DataFrame:
    """(column, rows, non_null, distinct) of every column: one scan, one shuffle."""
    slots = []
    for f in df.schema.fields:
        whole, floating, text = _typed_slots(f)
        slots.append(F.struct(F.lit(f.name).alias("column"), whole.alias("w"), floating.alias("f"), text.alias("t")))
    counts = (df.select(F.inline(F.array(*slots))).groupBy("column", "w", "f", "t").agg(F.count(F.lit(1)).alias("n")))
    some = F.coalesce(F.col("w").isNotNull() | F.col("f").isNotNull() | F.col("t").isNotNull(), F.lit(False))
    return counts.groupBy("column").agg(F.sum("n").alias("rows"), F.sum(F.when(some, F.col("n")).otherwise(0)).alias("non_null"),
                                        F.count_if(some).alias("distinct"))


def _summary(df: DataFrame, approx: bool = False) -> DataFrame:
    """P7 with the number of rows next to each column."""
    if approx:
        norm = normalize(df)
        aggs = [F.count(F.lit(1)).alias("::rows")]
        for c in df.columns:
            aggs += [F.count(_q(c)).alias(f"nn::{c}"), F.approx_count_distinct(_q(c)).alias(f"d::{c}")]
        wide = norm.agg(*aggs)
        stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col("`::rows`").alias("rows"),
                                             F.col(f"`nn::{c}`").alias("non_null"),
                                             F.col(f"`d::{c}`").alias("distinct")) for c in df.columns]))
        stats = wide.select(stack.alias("s")).select("s.*")
    else:
        stats = column_counts(df)
    zero = F.lit(0)
    rows, non_null, distinct = (F.coalesce(c, zero) for c in ("rows", "non_null", "distinct"))
    pct = lambda x: F.coalesce(F.round(F.try_divide(x * 100.0, rows), 2), F.lit(0.0))
    # one row per column on both sides; the aggregated side is the one a left join can broadcast
    return (_dtypes(df).join(F.broadcast(stats), "column", "left")
            .select("column", "dtype", non_null.cast("bigint").alias("non_null"), (rows - non_null).cast("bigint").alias("nulls"),
                    pct(rows - non_null).alias("null_pct"), distinct.cast("bigint").alias("distinct"),
                    pct(distinct).alias("distinct_pct"), "position", rows.cast("bigint").alias("rows")))


def column_summary(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: dtype, non-null, null, null %, distinct, distinct % (D10: 0 on empty)."""
    return _summary(df, approx).drop("rows")


def numeric_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """Min, max, mean (2 dp), median, std (2 dp) of each numeric column.

    The exact median comes from the brackets of
    :func:`basalt.operators.quantiles.quantile_columns`; the other statistics are
    one hash aggregate in codegen."""
    cols = numeric_columns(df)
    norm = normalize(df.select(*[_q(c) for c in cols]))
    aggs = []
    for c in cols:
        x = _q(c).cast("double")
        extra = [F.percentile_approx(x, 0.5, 10000).cast("double").alias("median")] if approx else []
        aggs.append(F.struct(F.lit(c).alias("column"), F.min(x).alias("min"), F.max(x).alias("max"),
                             F.round(F.avg(x), 2).alias("mean"), F.round(F.stddev_samp(x), 2).alias("std"),
                             *extra).alias(c))
    wide = norm.agg(*aggs)
    stats = wide.select(F.explode(F.array(*[_q(c) for c in cols])).alias("s")).select("s.*")
    if not approx:
        from basalt.operators.quantiles import quantile_columns
        med = quantile_columns(df, cols, [0.5]).select("column", F.col("q0").alias("median"))
        stats = stats.join(F.broadcast(med), "column", "left")  # one row per column on both sides
    return stats.select("column", "min", "max", "mean", "median", "std")


def describe(df: DataFrame, approx: bool = False) -> DataFrame:
    """Count, mean, std, min, 25 %, 50 %, 75 %, max of each numeric column
    (exact quartiles by brackets; joined as in :func:`numeric_stats`)."""
    cols = numeric_columns(df)
    probs = [0.25, 0.5, 0.75]
    norm = normalize(df.select(*[_q(c) for c in cols]))
    aggs = []
    for c in cols:
        x = _q(c).cast("double")
        extra = [F.percentile_approx(x, probs, 10000).cast("array<double>").alias("q")] if approx else []
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
                             *extra).alias(c))
    wide = norm.agg(*aggs)
    s = wide.select(F.explode(F.array(*[_q(c) for c in cols])).alias("s")).select("s.*")
    if approx:
        s = s.select("*", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"))
    else:
        from basalt.operators.quantiles import quantile_columns
        q = quantile_columns(df, cols, probs)
        s = s.join(F.broadcast(q.select("column", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
                                        F.col("q2").alias("p75"))), "column", "left")
    return s.select("column", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
                    "min", "p25", "p50", "p75", "max")


def top_values(df: DataFrame, k: int = TOP_VALUES, columns: list[str] | None = None) -> DataFrame:
    """The k most frequent non-null values of each text column (ties by value)."""
    cols = columns or text_columns(df)
    counts = value_counts_long(df, cols).where(F.col("value").isNotNull())
    from pyspark.sql import Window
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return (counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("column", "value", F.col("n").cast("bigint").alias("n"), F.col("rank").cast("int").alias("rank")))


def mean_text_length(df: DataFrame) -> DataFrame:
    """P10: mean character length of each text column, 1 decimal (nulls excluded)."""
    cols = text_columns(df)
    aggs = [F.round(F.avg(F.length(_q(c))), 1).alias(c) for c in cols]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _q(c).alias("avg_length"))
                                           for c in cols])).alias("s")).select("s.*")


def row_digest(df: DataFrame) -> list[Column]:
    """128 bits that tell the rows of ``df`` apart: two seeded hashes of all values and of which are null."""
    parts = [part for c in df.columns for part in (_q(c), _q(c).isNull())]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"_d{seed}") for seed in (1, 2)]


def duplicates(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row, count and % of all rows.

    Rows are told apart by :func:`row_digest`, so 16 bytes and a count move per distinct row of a
    task, whatever the length of its texts, and the aggregate stays in fixed-width hash maps."""
    norm = normalize(df)
    groups = norm.select(*row_digest(norm)).groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_n"))
    agg = groups.agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("dup"))
    return agg.select(F.coalesce("dup", F.lit(0)).cast("bigint").alias("duplicate_rows"),
                      F.coalesce(F.round(F.try_divide(F.col("dup") * 100.0, F.col("rows")), 2), F.lit(0.0))
                      .alias("duplicate_pct"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, rows): one aggregate pass, no shuffle of values."""
    norm = normalize(df)
    aggs = [F.count_if(_q(c).isNull()).alias(c) for c in df.columns] + [F.count(F.lit(1)).alias("__rows")]
    wide = norm.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _q(c).cast("bigint").alias("nulls"))
                                           for c in df.columns])).alias("s"), F.col("__rows").alias("rows")
                       ).select("s.*", "rows")


def empty_columns(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Columns with no value at all (a 0-row table has none, D10)."""
    nc = counts if counts is not None else null_counts(df)
    return nc.where((F.col("nulls") == F.col("rows")) & (F.col("rows") > 0)).select("column")


def high_cardinality(df: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """Distinct / rows > 0.95 on more than 100 rows."""
    s, rows = summary if summary is not None else _summary(df), F.col("rows")
    return s.where((F.try_divide(F.col("distinct"), rows) > HIGH_CARD_RATIO) & (rows > HIGH_CARD_MIN_ROWS)).select("column")


def categorical(df: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """Distinct / rows < 0.05 with more than one distinct value."""
    s = summary if summary is not None else _summary(df)
    ratio = F.try_divide(F.col("distinct"), F.col("rows"))
    return (s.where((ratio < CATEGORICAL_RATIO) & (F.col("distinct") > 1))
            .select("column", "distinct", F.round(ratio, 4).alias("ratio")))


def id_columns(df: DataFrame, summary: DataFrame | None = None, legacy_id_rule: bool = False) -> DataFrame:
    """Columns whose values are all distinct, on more than 10 rows, with an id-like name.

    The reference's precedence (``A and B and C or D``) makes every column whose
    name contains ``id`` an id column (D9); ``legacy_id_rule=True`` keeps that.
    """
    s, rows = summary if summary is not None else _summary(df), F.col("rows")
    name = F.lower("column")
    c_rule = name.isin(*ID_NAMES)
    d_rule = name.contains("id")
    unique = (F.col("distinct") == rows) & (rows > ID_MIN_ROWS)
    cond = (unique & c_rule) | d_rule if legacy_id_rule else unique & (c_rule | d_rule)
    return s.where(cond).select("column")


def date_like(df: DataFrame, share: float = DATE_SHARE) -> DataFrame:
    """Text columns whose non-null values parse as timestamps in more than
    ``share`` of cases; all values are judged, in one aggregate without a shuffle of values."""
    cols = text_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, parsed_share double")
    wide = df.agg(*[F.avg(F.when(_q(c).isNotNull(), F.try_to_timestamp(_q(c)).isNotNull().cast("double"))).alias(c)
                    for c in cols])
    shares = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), _q(c).alias("parsed_share")) for c in cols])))
    return shares.where(F.col("parsed_share") > share).select("column", F.round("parsed_share", 4).alias("parsed_share"))


def null_share(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Null cells over all cells, in %."""
    nc = counts if counts is not None else null_counts(df)
    n_cols = len(df.columns)
    return nc.agg(F.sum("nulls").alias("null_cells"), F.max("rows").alias("rows")).select(
        F.coalesce("null_cells", F.lit(0)).cast("bigint").alias("null_cells"),
        (F.coalesce("rows", F.lit(0)) * n_cols).cast("bigint").alias("cells"),
        F.coalesce(F.try_divide(F.col("null_cells") * 100.0, F.col("rows") * n_cols), F.lit(0.0)).alias("null_pct"))


def quality_score(df: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """100 minus penalties for duplicates, empty and high-cardinality columns, nulls.

    Two scans: the column summary (rows, nulls and distinct values of all columns)
    and the duplicate rows; both are folded to one row."""
    summary = summary if summary is not None else _summary(df)
    rows, distinct = F.col("rows"), F.col("distinct")
    per = summary.agg(
        F.count_if((F.col("nulls") == rows) & (rows > 0)).alias("n_empty"),
        F.count_if((F.try_divide(distinct, rows) > HIGH_CARD_RATIO) & (rows > HIGH_CARD_MIN_ROWS)).alias("n_high"),
        F.coalesce(F.try_divide(F.sum("nulls") * 100.0, F.sum("rows")), F.lit(0.0)).alias("null_pct"))
    d = duplicates(df).select(F.struct("duplicate_rows", "duplicate_pct")).scalar()  # one scan, one row
    dup_rows, dup_pct = d.getField("duplicate_rows"), d.getField("duplicate_pct")
    dup_pen = F.when(dup_rows > 0, F.least(dup_pct, F.lit(float(DUP_PENALTY_CAP)))).otherwise(F.lit(0.0))
    n_empty, n_high = F.col("n_empty"), F.col("n_high")
    score = (F.lit(100.0) - dup_pen - n_empty * EMPTY_COLUMN_PENALTY - n_high * HIGH_CARD_PENALTY
             - F.least(F.col("null_pct"), F.lit(float(NULL_PENALTY_CAP))))
    issues = (dup_rows > 0).cast("int") + (n_empty > 0).cast("int") + (n_high > 0).cast("int")
    return per.select(dup_rows.alias("duplicate_rows"), dup_pct.alias("duplicate_pct"),
                      n_empty.cast("bigint").alias("empty_columns"),
                      n_high.cast("bigint").alias("high_cardinality_columns"),
                      F.round("null_pct", 4).alias("null_pct"),
                      issues.alias("total_issues"),
                      F.greatest(F.lit(0.0), F.round(score, 1)).alias("score"))


def basic_info(df: DataFrame) -> DataFrame:
    """Rows and columns, then one row per column with its position and type."""
    rows = _row_count(df)
    return _dtypes(df).select("position", "column", "dtype", rows.cast("bigint").alias("rows"),
                              F.lit(len(df.columns)).alias("columns"))


def data_size(df: DataFrame) -> DataFrame:
    """Bytes of the table as stored values: text and binary by octet length,
    fixed-width types by their width; nulls take no bytes."""
    parts = []
    for f in df.schema.fields:
        c = _q(f.name)
        t = f.dataType.simpleString()
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint"))
        elif t in FIXED_WIDTH:
            parts.append(F.when(c.isNotNull(), F.lit(FIXED_WIDTH[t])).otherwise(0).cast("bigint"))
        else:
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)).cast("bigint"))
    per_row = reduce(lambda a, b: a + b, parts)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint").alias("bytes")) \
        .withColumn("mb", F.round(F.col("bytes") / 1048576.0, 2))


def head(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First n rows by an explicit key."""
    return df.orderBy(*[F.asc(c) for c in order_by]).limit(n)


def tail(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """Last n rows by an explicit key (top-k on the reversed key), in key order."""
    last = df.orderBy(*[F.desc(c) for c in order_by]).limit(n)
    return last.orderBy(*[F.asc(c) for c in order_by])


def sample_rows(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """P5: n random rows: a top-k on the MD5 of seed and key, so no full sort, and the
    same rows whatever the partitioning or engine."""
    text = F.concat_ws("/", F.lit(str(seed)), *[F.coalesce(_q(c).cast("string"), F.lit("")) for c in key])
    return df.orderBy(F.md5(text), *[_q(c) for c in key]).limit(n)


def report(df: DataFrame) -> DataFrame:
    """The whole analysis as (section, name, value) rows.

    The per-column counts and the duplicates are computed once each and written
    to the shared folder; every section derives from them (dates: one more
    aggregate over the text columns)."""
    from basalt.session import written
    summary = written(_summary(df), "report")
    q = quality_score(df, summary)

    def rows(section: str, frame: DataFrame, name, value) -> DataFrame:
        return frame.select(F.lit(section).alias("section"), name.alias("name"), value.cast("string").alias("value"))

    quality = q.select(F.inline(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).cast("string").alias("value")) for k in (
        "score", "total_issues", "duplicate_rows", "empty_columns", "high_cardinality_columns")])))
    column = F.col("column")
    per_column = summary.select("column", F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in ("dtype", "non_null", "nulls", "distinct")])))
    none = F.lit(None)
    sections = [
        rows("quality", quality, F.col("name"), F.col("value")),
        rows("basic", summary.agg(F.coalesce(F.max("rows"), F.lit(0)).alias("n")), F.lit("rows"), F.col("n")),
        rows("basic", summary.agg(F.count(F.lit(1)).alias("n")), F.lit("columns"), F.col("n")),
        rows("column", per_column, F.concat_ws(".", column, "k"), F.col("v")),
        rows("date_column", date_like(df), column, F.col("parsed_share")),
        rows("categorical_column", categorical(df, summary), column, F.col("distinct")),
        rows("id_column", id_columns(df, summary), column, none),
    ]
    return reduce(DataFrame.unionByName, sections)
