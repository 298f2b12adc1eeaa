"""Exact quantiles by narrowing brackets.

Spark's exact ``percentile`` keeps a value -> count map per group and merges
the maps of a global aggregate in one task: memory grows with the number of
distinct values.  A sort moves and writes every value for a few ranks.  Here
every quantile is narrowed to a bracket of values, at every size the same way:

1. one scan gives each column's count, least and greatest value, and one a histogram of
   ``BUCKETS`` equal parts between them, with the ends and counts of its buckets; the
   bucket that holds a wanted rank is the first bracket, already counted;
2. a bracket with more than ``LIMIT`` values (very many rows, or values of very different
   size) is narrowed: the mergeable summary of ``percentile_approx`` gives two of its values
   that enclose the rank with room for the summary's error, and one scan counts the values
   below and inside; a bracket that missed is opened to the side it missed on.  A few
   ten-thousandths of the values stay each time;
3. only the values inside the brackets move: equal values are counted before the shuffle,
   so one that fills a third of a column is one row per task, and
   the running count gives the value at each rank;
4. linear interpolation as in ``percentile`` / ``quantile_cont``.

Nothing is sorted as a whole and nothing is written.  The driver holds one bracket per
column and quantile.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basalt.operators.profile import _q, normalize

#: Buckets of the first histogram.
BUCKETS = 4096
#: Accuracy of the summaries (their rank error is one in so many rows), and the values one bracket may bring to one task.
ACCURACY, LIMIT = 10_000, 1_000_000


@dataclass(frozen=True)
class Bracket:
    """One quantile of one column: its position among ``n`` values, and values known to enclose it."""

    c: int  # position of the column
    prob: float
    n: int
    low: float | None = None  # None: open
    high: float | None = None
    below: int = 0
    inside: int = 0

    @property
    def position(self) -> float:
        return self.prob * (self.n - 1)

    def shares(self) -> list[float]:
        """Shares of the values inside the bracket that enclose the wanted ranks, error included."""
        room = 2 / ACCURACY + 2 / max(self.inside, 1)
        first, last = floor(self.position) - self.below, ceil(self.position) - self.below
        return [max(0.0, first / max(self.inside, 1) - room), min(1.0, (last + 1) / max(self.inside, 1) + room)]


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows as part of the plan (no job, no Python worker)."""
    fields = [f.split() for f in schema.split(", ")]
    cells = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def _with_brackets(long: DataFrame, brackets: list[Bracket]) -> DataFrame:
    """Values (c, v) with the brackets of their column (broadcast: one row per column and quantile)."""
    rows = [(b.c, t, b.low, b.high) for t, b in enumerate(brackets)]
    return long.join(F.broadcast(_table(long.sparkSession, rows, "c int, t int, low double, high double")), "c")


def _below() -> Column:
    return F.col("low").isNotNull() & (F.col("v") < F.col("low"))


def _inside() -> Column:
    return (F.col("low").isNull() | (F.col("v") >= F.col("low"))) & (F.col("high").isNull() | (F.col("v") <= F.col("high")))


def _from_histogram(vals: DataFrame, long: DataFrame, columns: list[str], probs: list[float]) -> list[Bracket]:
    """A counted bracket per quantile of each column that has values: the bucket, or the two, that hold its ranks."""
    finite = [F.when(F.abs(_q(c)) < float("inf"), _q(c)) for c in columns]
    ends = vals.agg(*[F.struct(F.count(_q(c)).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).alias(f"c{i}")
                      for i, (c, x) in enumerate(zip(columns, finite, strict=True))]).first()
    if not any(e["n"] for e in ends):
        return []
    low, high = (F.get(F.array(*[F.lit(e[name]).cast("double") for e in ends]), F.col("c")) for name in ("low", "high"))
    # halved, so that the width cannot overflow; null where all finite values are equal or there is none
    part = F.floor(F.try_divide(F.col("v") / 2 - low / 2, high / 2 - low / 2) * BUCKETS)
    bucket = F.when(F.col("v") < low, -1).when(F.col("v") > high, BUCKETS).otherwise(
        F.coalesce(F.least(part, F.lit(BUCKETS - 1)), F.lit(0))).cast("int")
    hist = (long.select("c", bucket.alias("b"), "v").groupBy("c", "b")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))
    upto = F.sum("n").over(Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
    wanted = [Bracket(i, float(p), e["n"]) for i, e in enumerate(ends) if e["n"] for p in probs]
    at = [(b.c, t, rank) for t, b in enumerate(wanted) for rank in (floor(b.position), ceil(b.position))]
    targets = _table(vals.sparkSession, at, "c int, t int, rank long")  # two rows per column and quantile
    found = (hist.withColumn("end", upto).join(F.broadcast(targets), "c")
             .where((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n")))
             .groupBy("t").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                               F.min(F.col("end") - F.col("n")).alias("below"), F.max("end").alias("end")).collect())
    for r in found:
        wanted[r["t"]] = replace(wanted[r["t"]], low=r["low"], high=r["high"], below=r["below"], inside=r["end"] - r["below"])
    return wanted


def _narrowed(long: DataFrame, brackets: list[Bracket]) -> list[Bracket]:
    """Brackets around the wanted ranks from a summary of the values inside the old ones, counted exactly."""
    tried = list(brackets)
    shares = sorted({s for b in brackets for s in b.shares()})
    found = (_with_brackets(long, brackets).where(_inside()).groupBy("t")
             .agg(F.percentile_approx("v", F.array(*[F.lit(s) for s in shares]), F.lit(ACCURACY)).alias("ends")).collect())
    for r in found:  # one row per column and quantile
        b = brackets[r["t"]]
        low, high = (r["ends"][shares.index(s)] for s in b.shares())
        tried[r["t"]] = replace(b, low=low, high=high)
    return _counted(long, brackets, tried)


def _counted(long: DataFrame, old: list[Bracket], tried: list[Bracket]) -> list[Bracket]:
    """``tried`` with exact counts; an end that missed its rank goes back to the old bracket's."""
    out = list(tried)
    counts = (_with_brackets(long, tried).groupBy("t")
              .agg(F.count_if(_below()).alias("below"), F.count_if(_inside()).alias("inside")).collect())
    missed = False
    for r in counts:
        b = replace(tried[r["t"]], below=r["below"], inside=r["inside"])
        if b.below > floor(b.position):
            b, missed = replace(b, low=old[r["t"]].low), True
        if b.below + b.inside <= ceil(b.position):
            b, missed = replace(b, high=old[r["t"]].high), True
        out[r["t"]] = b
    return _counted(long, old, out) if missed else out


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """(column, prob, value): exact, linearly interpolated quantiles of each column.

    NaN and NULL are ignored; a column without values gives NULL."""
    cols, spark = list(columns), df.sparkSession
    vals = normalize(df.select(*[_q(c).cast("double").alias(c) for c in cols]))
    long = vals.select(F.posexplode(F.array(*[_q(c) for c in cols])).alias("c", "v")).where(F.col("v").isNotNull())
    brackets = _from_histogram(vals, long, cols, probs)
    while any(b.inside > LIMIT and b.low != b.high for b in brackets):
        narrower = _narrowed(long, brackets)
        if all(n.inside == b.inside for n, b in zip(narrower, brackets, strict=True)):
            break  # only ties are left inside
        brackets = narrower
    if not brackets:
        return _table(spark, [(c, float(p), None) for c in cols for p in probs], "column string, prob double, value double")
    ranks = [(t, floor(b.position) - b.below, ceil(b.position) - b.below, b.position - floor(b.position))
             for t, b in enumerate(brackets)]
    wanted = _table(spark, ranks, "t int, lo long, hi long, part double")
    values = _with_brackets(long, brackets).where(_inside()).groupBy("t", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    at = lambda rank: F.max(F.when((F.col("end") > F.col(rank)) & (F.col("end") - F.col("n") <= F.col(rank)), F.col("v")))
    picked = (values.withColumn("end", upto).join(F.broadcast(wanted), "t").groupBy("t", "part").agg(at("lo").alias("l"), at("hi").alias("h")))
    value = F.when(F.col("part") == 0, F.col("l")).otherwise((1 - F.col("part")) * F.col("l") + F.col("part") * F.col("h"))
    # columns without any value still get a (NULL) row per prob
    at_t = {(cols[b.c], b.prob): t for t, b in enumerate(brackets)}
    rows = [(c, float(p), at_t.get((c, float(p)))) for c in cols for p in probs]
    return (_table(spark, rows, "column string, prob double, t int")
            .join(F.broadcast(picked.select("t", value.alias("value"))), "t", "left").drop("t"))


def quantile_columns(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """One row per column, one ``q<k>`` column per prob (in the order given)."""
    q = exact_quantiles(df, columns, probs)
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(f"q{i}") for i, p in enumerate(probs)]
    return q.groupBy("column").agg(*aggs)
