"""Helpers shared by the operators: tables, written intermediates, code shipping, components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.session import scratch_dir

#: Rows and bytes of one Arrow batch handed to a Python task (bounds its memory).
BATCH_ROWS, BATCH_BYTES = 1024, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches and make this package importable in the tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_basalt_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="basalt-code-"), "basalt_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("basalt", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._basalt_shipped = True


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage, is computed once and survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (a, b): rows (id, component), where
    component is the smallest id reachable; ids without a link are not listed.

    Alternating large-star / small-star contraction.  Each step is a min
    aggregate with a map-side part and an equi-join that AQE can split, so a
    hub with very many links is no problem.  Every round is written to the
    shared folder; the loop ends when only stars are left.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    for _ in range(max_rounds):
        if _are_stars(edges):
            break
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = materialize(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = materialize(small, "cc")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
            .unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or is a centre, never both."""
    ends = (edges.select(F.col("u").alias("id"), F.lit(1).alias("leaf"), F.lit(0).alias("centre"))
            .unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))))
    nodes = ends.groupBy("id").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return nodes.where("leaf > 1 or (leaf = 1 and centre = 1)").isEmpty()
