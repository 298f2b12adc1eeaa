"""Interactive exploration numbers: histogram, box plot, correlations, value
counts, value filters, search and paged views (P20-P28).

Bounds (min, max, quartiles) enter the row-level expressions as scalar
subqueries, so each operator is one plan: a global aggregate first, then
the per-row step; no value travels through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basalt.operators.profile import _q, normalize, text_columns

HIST_BINS = 30          # P20
VALUE_COUNT_TOP = 15    # P23
DISTINCT_CAP = 50       # P24
IQR_FENCE = 1.5         # P21


def histogram(df: DataFrame, column: str, bins: int = HIST_BINS) -> DataFrame:
    """P20: equal-width bins between min and max; max falls into the last bin,
    a constant column into bin 1.  (bin, lower, upper, count), empty bins omitted."""
    x = _q(column).cast("double")
    clean = normalize(df.select(x.alias("v"))).where(F.col("v").isNotNull())
    bounds = clean.select(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(1)).otherwise(F.least(F.width_bucket("v", lo, hi, F.lit(bins)), F.lit(bins)))
    counted = clean.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.col("bin").cast("int").alias("bin"),
                          (lo + (F.col("bin") - 1) * width).alias("lower"),
                          F.when(hi == lo, hi).otherwise(lo + F.col("bin") * width).alias("upper"),
                          "count")


def _quartiles(df: DataFrame, column: str, approx: bool) -> Column:
    """Scalar struct (q0, q1, q2) = 25 / 50 / 75 % of one column."""
    if approx:
        clean = normalize(df.select(_q(column).cast("double").alias("v"))).where(F.col("v").isNotNull())
        q = clean.select(F.percentile_approx("v", [0.25, 0.5, 0.75], 10000).alias("q"))
        return q.select(F.struct(F.col("q")[0].alias("q0"), F.col("q")[1].alias("q1"),
                                 F.col("q")[2].alias("q2"))).scalar()
    from basalt.operators.quantiles import quantile_columns
    t = quantile_columns(df, [column], [0.25, 0.5, 0.75])
    return t.select(F.struct("q0", "q1", "q2")).scalar()


def box_stats(df: DataFrame, column: str, approx: bool = False, fence: float = IQR_FENCE) -> DataFrame:
    """Quartiles, IQR fences, whiskers (extreme values inside the fences)
    and the number of outliers; one row."""
    clean = normalize(df.select(_q(column).cast("double").alias("v"))).where(F.col("v").isNotNull())
    qs = _quartiles(df, column, approx)
    q1, q3 = qs.getField("q0"), qs.getField("q2")
    iqr = q3 - q1
    lo_f, hi_f = q1 - fence * iqr, q3 + fence * iqr
    inside = (F.col("v") >= lo_f) & (F.col("v") <= hi_f)
    return clean.agg(
        F.lit(column).alias("column"),
        F.first(q1).alias("q1"), F.first(qs.getField("q1")).alias("median"), F.first(q3).alias("q3"),
        F.first(iqr).alias("iqr"), F.first(lo_f).alias("lower_fence"), F.first(hi_f).alias("upper_fence"),
        F.min(F.when(inside, F.col("v"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("v"))).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, column: str, fence: float = IQR_FENCE) -> DataFrame:
    """The rows outside the IQR fences (NaN is missing, not an outlier)."""
    x = F.nanvl(_q(column).cast("double"), F.lit(None).cast("double"))
    qs = _quartiles(df, column, False)
    q1, q3 = qs.getField("q0"), qs.getField("q2")
    iqr = q3 - q1
    return df.where((x < q1 - fence * iqr) | (x > q3 + fence * iqr))


#: Pairs of one aggregate row; with six sums each they stay within the fields that generated code takes.
CORR_BLOCK = 8


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair (both orders and the diagonal), over the rows
    where both are present; (column_a, column_b, corr), null where a column does not vary.

    Two scans: the column means, then the moments of all pairs about them.  Each row is
    generated once per (column, block of ``CORR_BLOCK`` columns) of the upper triangle and adds to
    six sums per pair there.  The plan has that many aggregates for any number of columns,
    all in generated code and merged map-side; one ``corr`` per pair would be interpreted from
    about 16 pairs on."""
    k = len(columns)
    norm = normalize(df.select(*[_q(c).cast("double").alias(c) for c in columns]))
    means = norm.agg(F.array(*[F.avg(_q(c)) for c in columns]).alias("m")).scalar()
    cells = [(i, j) for i in range(k) for j in range(i - i % CORR_BLOCK, k, CORR_BLOCK)]
    n_blocks = -(-k // CORR_BLOCK)
    row = norm.withColumn("__m", means).select(
        F.array(*[_q(c) - F.get("__m", F.lit(i)) for i, c in enumerate(columns)]).alias("v"),
        F.explode(F.array(*[F.lit(i * n_blocks + j // CORR_BLOCK) for i, j in cells])).alias("cell"))
    i, first = F.floor(F.col("cell") / n_blocks).cast("int"), (F.col("cell") % n_blocks) * CORR_BLOCK
    block = row.select("cell", F.get("v", i).alias("x"), *[F.get("v", first + t).alias(f"y{t}") for t in range(CORR_BLOCK)])
    sums, corrs = [], []
    for t in range(CORR_BLOCK):
        xy = F.col("x") * F.col(f"y{t}")
        x, y = (F.when(xy.isNotNull(), F.col(c)) for c in ("x", f"y{t}"))
        sums += [F.count(xy).alias(f"n{t}"), F.sum(xy).alias(f"xy{t}"), F.sum(x).alias(f"sx{t}"), F.sum(y).alias(f"sy{t}"),
                 F.sum(x * x).alias(f"xx{t}"), F.sum(y * y).alias(f"yy{t}")]
        n, sxy, sx, sy, sxx, syy = (F.col(f"{name}{t}") for name in ("n", "xy", "sx", "sy", "xx", "yy"))
        var_x, var_y = sxx - F.try_divide(sx * sx, n), syy - F.try_divide(sy * sy, n)
        varies = (var_x > sxx * 1e-13) & (var_y > syy * 1e-13)  # less is rounding of values that are all equal
        corr = F.try_divide(sxy - F.try_divide(sx * sy, n), F.sqrt(var_x) * F.sqrt(var_y))
        corrs.append(F.struct((first + t).alias("j"), F.when(varies, F.greatest(F.least(corr, F.lit(1.0)), F.lit(-1.0))).alias("corr")))
    pairs = block.groupBy("cell").agg(*sums).select(i.alias("i"), F.inline(F.array(*corrs)))
    upper = pairs.where((F.col("j") >= F.col("i")) & (F.col("j") < k))
    ends = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    names = F.array(*[F.lit(c) for c in columns])
    return (upper.select("corr", F.explode(ends).alias("e"))
            .select(F.get(names, F.col("e.i")).alias("column_a"), F.get(names, F.col("e.j")).alias("column_b"), "corr"))


def value_counts(df: DataFrame, column: str, k: int = VALUE_COUNT_TOP) -> DataFrame:
    """The k most frequent non-null values (ties by value); top-k, no full sort."""
    counts = (df.where(_q(column).isNotNull()).groupBy(_q(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("count")))
    return counts.orderBy(F.desc("count"), F.asc("value")).limit(k)


def distinct_values(df: DataFrame, column: str, cap: int | None = None) -> DataFrame:
    """The distinct non-null values and whether more exist; with ``cap`` the smallest
    ``cap`` of them (``DISTINCT_CAP`` is what the view shows)."""
    d = df.where(_q(column).isNotNull()).select(_q(column).alias("value")).distinct()
    if cap is None:
        return d.withColumn("more_values", F.lit(False))
    first = d.orderBy("value").limit(cap + 1)
    more = first.select((F.count(F.lit(1)) > cap).alias("m")).scalar()
    return first.orderBy("value").limit(cap).withColumn("more_values", more)


def filter_values(df: DataFrame, column: str, values) -> DataFrame:
    """P25: rows whose value is in ``values``; an empty set means no filter.

    ``values`` may be a list (``isin``) or a one-column DataFrame (left semi
    join, for long lists)."""
    if isinstance(values, DataFrame):
        # a semi join emits each row once whatever the repeats in ``values``,
        # so no distinct (and no extra shuffle) is needed on that side
        v = values.select(values.columns[0]).withColumnRenamed(values.columns[0], "__v")
        return df.join(v, _q(column) == F.col("__v"), "left_semi")
    vals = list(values)
    if not vals:
        return df
    return df.where(_q(column).isin(*vals))


def search(df: DataFrame, term: str, columns: list[str] | None = None) -> DataFrame:
    """Rows where any text column matches ``term`` (regular expression,
    case-insensitive).  No match -> no rows (D12)."""
    cols = columns or text_columns(df)
    if not term or not cols:
        return df
    cond = reduce(lambda a, b: a | b, [F.coalesce(_q(c).rlike("(?i)" + term), F.lit(False)) for c in cols])
    return df.where(cond)


def explore(df: DataFrame, filters: dict | None = None, term: str | None = None, page_no: int = 1,
            page_size: int = 20, order: list[Column] | None = None) -> DataFrame:
    """Value filters AND search (D11), then one numbered page with totals."""
    out = df
    for col, values in (filters or {}).items():
        out = filter_values(out, col, values)
    if term:
        out = search(out, term)
    from basalt.operators.manifest import page
    return page(out, page_no, page_size, order or [F.asc(c) for c in df.columns])


__all__ = ["box_outliers", "box_stats", "correlation_matrix", "distinct_values", "explore", "filter_values",
           "histogram", "search", "value_counts", "Window"]
