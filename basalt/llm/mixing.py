"""Mixing sources to target weights by capped water-filling.

Sources share the total number of words by weight.  A source whose share is
above ``max_epochs`` times its size is clamped there, and its excess goes to
the others by weight; this repeats until none is above.  Documents then take
their source's whole epochs, and the fractional epoch goes to the documents
that come first in a seeded hash order, up to the exact word count: the last
one is repeated in part.

Hot sources: running word counts are two-level (hash ranges of a source, then
inside a range), so no task holds a source; sums are combined map-side.  Only
one row per source reaches the weighting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basalt.llm.common import materialize

#: Word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SEED, MAX_EPOCHS, WEIGHTS = "mix-1", 3, (1, 2, 3)
#: Hash ranges into which each source is cut for running counts.
RANGE_BITS = 10


def water_fill(sizes: list[int], weights: list[float], max_epochs: float) -> list[float]:
    """Targets that share ``sum(sizes)`` by weight, none above ``max_epochs * size``."""
    caps = [max_epochs * s for s in sizes]
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in sorted(free))
        share = {i: left * weights[i] / total for i in sorted(free)}
        over = [i for i in sorted(free) if share[i] > caps[i]]
        if not over:
            for i, s in share.items():
                targets[i] = s
            break
        for i in over:
            targets[i] = float(caps[i])
            left -= caps[i]
            free.discard(i)
    return targets


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size) -> the same with weight and target.

    One row per source, whatever the number of documents: sources are ordered
    by code point (null last) and weighed ``weights`` in turn.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    ranked = sizes.withColumn("weight", F.get(F.lit(list(weights)), ((F.row_number().over(order) - 1) % n)))
    ranked = materialize(ranked, "mix-sources")
    rows = ranked.collect()  # one row per source
    targets = water_fill([r["source_size"] for r in rows], [r["weight"] for r in rows], max_epochs)
    spark = sizes.sparkSession
    schema = "source string, source_size long, weight int, target double"
    return spark.createDataFrame([(r["source"], r["source_size"], r["weight"], t)
                                  for r, t in zip(rows, targets, strict=True)], schema)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        max_epochs: int = MAX_EPOCHS, weights: tuple = WEIGHTS, seed: str = SEED) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, copies.

    ``size`` is the number of words (null text: 0), ``taken`` the words the mix
    takes (repeats counted; at most ``max_epochs * size``), ``copies`` the
    number of whole repetitions nearest to it.  The words taken from a source
    add up to its target, rounded down.  Null sources are one source, last in
    order.  Order of documents: md5 of seed and id, then size, so reruns agree;
    rows that agree in all of these are interchangeable.  Sources without
    words take nothing.  Empty tables give an empty result.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                     F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0))
                     .cast("long").alias("size"))
    order = F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    docs = materialize(docs.withColumn("rank", order)
                       .withColumn("cell", F.shiftright(F.conv(F.substring("rank", 1, 4), 16, 10).cast("int"),
                                                        16 - RANGE_BITS)), "mix-docs")
    cells = docs.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("cell_before", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
    targets = source_targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), max_epochs, weights)
    known = (cells.alias("c").join(targets.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
             .select("c.source", "cell", "cell_before", "source_size", "target"))
    inner = (Window.partitionBy("source", "cell").orderBy("rank", "size", F.col("doc_id"))
             .rowsBetween(Window.unboundedPreceding, -1))
    local = docs.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    joined = (local.alias("d").join(known.alias("k"), (F.col("d.cell") == F.col("k.cell"))
                                    & F.col("d.source").eqNullSafe(F.col("k.source")))
              .select("doc_id", "size", "source_size", "target", (F.col("cell_before") + F.col("inside")).alias("start")))
    words = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0))
    extra = words - F.col("whole") * F.col("source_size") - F.col("start")
    part = F.least("size", F.greatest(extra, F.lit(0)))
    return (joined.withColumn("whole", whole).withColumn("part", part)
            .select("doc_id", "size", "source_size", "target",
                    (F.col("whole") * F.col("size") + F.col("part")).alias("taken"),
                    (F.col("whole") + F.when(F.when(F.col("size") > 0, F.col("part") * 2 >= F.col("size"))
                                             .otherwise(extra > 0), 1).otherwise(0)).alias("copies")))


def apply_mix(df: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The mixed documents: each row of ``df`` as often as ``copies`` says (0: left
    out).  Rows stay whole; the one document of a source that is taken in part
    is rounded to whole repetitions."""
    copies = (mix(df, id_col=id_col, **kw).groupBy(F.col("doc_id").alias("__mix_id"))
              .agg(F.max("copies").cast("int").alias("__mix_copies")))
    out = df.join(copies, F.col(id_col).eqNullSafe(F.col("__mix_id")))
    return (out.where("__mix_copies > 0")
            .withColumn("__mix_n", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
            .select(*[out[c] for c in df.columns]))
