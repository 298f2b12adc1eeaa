"""The distributed exact quantiles equal Spark's map-based percentile, also with a
hot value (a third of all rows) and an empty column."""

from pyspark.sql import functions as F

from basalt.operators import explore, profile, quantiles
from basalt.operators.quantiles import quantile_columns


def test_quantiles_equal_percentile(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 37 % 1001).cast("double")).alias("hot"),
        (F.col("id") / 7.0).alias("lin"),
        F.lit(None).cast("double").alias("empty"),
        F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 13).cast("double").alias("nan"),
    ).repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    cols = ["hot", "lin", "empty", "nan"]
    got = {r["column"]: tuple(r[f"q{i}"] for i in range(len(probs))) for r in quantile_columns(df, cols, probs).collect()}
    want = profile.normalize(df).agg(*[F.percentile(c, probs).alias(c) for c in cols]).first()
    assert got == {c: tuple(want[c] or (None,) * len(probs)) for c in cols}


def test_describe_and_numeric_stats_have_the_quartiles(spark):
    df = spark.range(2000).select((F.col("id") % 97).alias("a"), (F.col("id") / 3.0).alias("b"),
                                  F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id")).alias("c"))
    want = df.agg(*[F.percentile(c, [0.25, 0.5, 0.75]).alias(c) for c in df.columns]).first()
    for r in profile.describe(df).collect():
        assert [r["p25"], r["p50"], r["p75"]] == want[r["column"]]
    assert {r["column"]: r["median"] for r in profile.numeric_stats(df).collect()} == {c: want[c][1] for c in df.columns}


def test_box_outliers_leave_out_nan(spark):
    from basalt.operators import explore
    df = spark.createDataFrame([(float(x),) for x in range(20)] + [(500.0,), (float("nan"),), (None,)], "x double")
    assert [r["x"] for r in explore.box_outliers(df, "x").collect()] == [500.0]
    assert explore.box_stats(df, "x").first()["outliers"] == 1


def test_zero_and_negative_zero_are_one_value(spark):
    df = spark.createDataFrame([(0.0, "a" * 100), (-0.0, "a" * 100), (1.0, "a" * 99 + "b")], "x double, t string")
    assert {r["column"]: r["distinct"] for r in profile.column_summary(df).collect()} == {"x": 2, "t": 2}


def _check(spark, df, probs):
    got = {r["column"]: tuple(r[f"q{i}"] for i in range(len(probs))) for r in quantile_columns(df, df.columns, probs).collect()}
    want = profile.normalize(df).agg(*[F.percentile(c, probs).alias(c) for c in df.columns]).first()
    assert got == {c: tuple(want[c] or (None,) * len(probs)) for c in df.columns}


def test_brackets_narrow_until_they_fit(spark, monkeypatch):
    """With a bound of 20 values per bracket every step runs, also over ties, outliers and infinities."""
    monkeypatch.setattr(quantiles, "LIMIT", 20)
    monkeypatch.setattr(quantiles, "BUCKETS", 4)
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.sqrt("id")).alias("ties"),
        F.pow(F.lit(10.0), F.col("id") % 600 - 300).alias("scales"),
        F.when(F.col("id") == 7, float("inf")).when(F.col("id") < 5, float("-inf")).otherwise(F.rand(3)).alias("infinite"),
        F.lit(2.5).alias("constant"), (F.col("id") % 2 * 1.7e308 - 0.85e308).alias("huge"), F.rand(5).alias("even")).repartition(5)
    df = spark.createDataFrame(df.collect(), df.schema).repartition(5)
    _check(spark, df, [0.0, 0.001, 0.25, 0.5, 0.77, 0.9999, 1.0])


def test_a_bracket_that_missed_is_opened(spark):
    long = spark.createDataFrame([(0, float(i)) for i in range(100)], "c int, v double")
    whole = quantiles.Bracket(0, 0.5, 100, inside=100)
    (b,) = quantiles._counted(long, [whole], [quantiles.replace(whole, low=60.0, high=70.0)])
    assert (b.low, b.high, b.below, b.inside) == (None, 70.0, 0, 71)
    (b,) = quantiles._counted(long, [whole], [quantiles.replace(whole, low=10.0, high=20.0)])
    assert (b.low, b.high, b.below, b.inside) == (10.0, None, 10, 90)


def test_duplicates_look_at_nulls_types_and_long_texts(spark):
    rows = [(None, 1, "a" * 500), (1, None, "a" * 500), (None, 1, "a" * 500), (1, None, "a" * 499 + "b"), (None, None, None),
            (None, None, None), (0, 0, ""), (0, 0, None)]
    df = spark.createDataFrame(rows, "a int, b int, t string").withColumn("s", F.struct("a", "t"))
    assert profile.duplicates(df).first()["duplicate_rows"] == 2
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "x double")
    assert profile.duplicates(zeros).first()["duplicate_rows"] == 2


def test_correlation_of_many_columns_with_nulls(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(4)
    x = rng.normal(1e6, 1, (300, 21)).cumsum(axis=1)
    x[rng.random(x.shape) < 0.2] = np.nan
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(21)])
    frame["flat"] = 3.0
    got = {(r["column_a"], r["column_b"]): r["corr"]
           for r in explore.correlation_matrix(spark.createDataFrame(frame), list(frame.columns)).collect()}
    want = frame.corr()
    assert len(got) == 22 * 22
    for (a, b), v in got.items():
        assert v is None if "flat" in (a, b) else abs(v - want.loc[a, b]) < 1e-9, (a, b, v, want.loc[a, b])


def test_correlation_of_200_columns_runs(spark):
    df = spark.range(200).select(*[(F.col("id") * (i % 7 + 1) % 101).alias(f"c{i}") for i in range(200)])
    assert explore.correlation_matrix(df, df.columns).count() == 200 * 200
