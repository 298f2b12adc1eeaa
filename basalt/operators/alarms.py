"""Threshold alarms over five-minute series.

A rule is (alarm, metric, comparison, threshold, statistic); it breaches in
a period when the period's statistic compares true with the threshold, and it
is in ALARM when the last two periods both breach.  A missing period counts
as not breaching; with no data in either period the state is
INSUFFICIENT_DATA.

Rules are a handful of rows and are broadcast.  The two-period test is one
aggregate over (rule, period): each row also stands as the predecessor of the
next period, so no task has to hold a metric's whole history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.operators.metrics import PERIOD_SECONDS, covering_range

RULE_SCHEMA = "alarm string, metric string, comparison string, threshold double, statistic string"
GREATER, LESS = "GreaterThanThreshold", "LessThanThreshold"
OK, ALARM, INSUFFICIENT = "OK", "ALARM", "INSUFFICIENT_DATA"
EVALUATION_PERIODS = 2

# Default rules of the pipeline (fixed values).
DEFAULT_RULES = [
    ("DataLake-ProcessingErrors", "FilesError", GREATER, 5.0, "Sum"),
    ("DataLake-SlowProcessing", "ProcessingTime", GREATER, 300.0, "Sum"),
    ("DataLake-LowSQSSuccess", "SQSSuccessRate", LESS, 80.0, "Sum"),
    ("DataLake-LargeFiles", "FileSize", GREATER, 104857600.0, "Sum"),
    ("DataLake-SQSBacklog", "SQSMessagesReceived", GREATER, 50.0, "Sum"),
]


def rules(spark: SparkSession, rows=None) -> DataFrame:
    """The rule table (default: the five pipeline rules)."""
    return spark.createDataFrame(rows or DEFAULT_RULES, RULE_SCHEMA)


def statistic_of(total: Column, average: Column, maximum: Column, samples: Column) -> Column:
    """The value that a rule's ``statistic`` names."""
    s = F.col("statistic")
    return (F.when(s == "Sum", total).when(s == "Average", average)
            .when(s == "Maximum", maximum).when(s == "SampleCount", samples.cast("double")))


def breaches(value: Column) -> Column:
    """Whether a value breaches the rule's ``threshold`` by its ``comparison``."""
    t, c = F.col("threshold"), F.col("comparison")
    return (F.when(c == GREATER, value > t).when(c == LESS, value < t)
            .when(c == "GreaterThanOrEqualToThreshold", value >= t).when(c == "LessThanOrEqualToThreshold", value <= t))


def state_of(breach: Column, prev_breach: Column) -> Column:
    """ALARM where two periods in a row breach."""
    return F.when(breach & prev_breach, F.lit(ALARM)).otherwise(F.lit(OK))


def rule_periods(stats: DataFrame, rule_df: DataFrame) -> DataFrame:
    """Each rule's statistic per period, with its breach flag."""
    joined = stats.join(F.broadcast(rule_df), "metric")
    return joined.select("alarm", "metric", "comparison", "threshold", "statistic", "period_start",
                         statistic_of(*[F.col(c) for c in ("sum", "average", "maximum", "samples")]).alias("value")
                         ).withColumn("breach", breaches(F.col("value")))


def alarm_history(stats: DataFrame, rule_df: DataFrame) -> DataFrame:
    """Per rule and period with data: value, breach, previous period's breach, state.

    Every (rule, period) row is emitted twice, as itself and as the predecessor
    of the next period, and both meet in one aggregate: the series is computed
    once and no task holds a metric's history."""
    cur = rule_periods(stats, rule_df)
    none = F.lit(None)
    later = F.col("period_start") + F.expr(f"INTERVAL {PERIOD_SECONDS} SECONDS")
    pair = F.inline(F.array(
        F.struct(F.col("period_start").alias("at"), F.lit(True).alias("here"), F.col("value").alias("v"),
                 F.col("breach").alias("b"), none.cast("boolean").alias("before")),
        F.struct(later.alias("at"), F.lit(False).alias("here"), none.cast("double").alias("v"),
                 none.cast("boolean").alias("b"), F.col("breach").alias("before"))))
    both = cur.select("alarm", "metric", pair)
    h = (both.groupBy("alarm", "metric", F.col("at").alias("period_start"))
         .agg(F.max("here").alias("here"), F.max("v").alias("value"), F.max("b").alias("breach"),
              F.coalesce(F.max("before"), F.lit(False)).alias("prev_breach")).where("here"))
    return h.select("alarm", "metric", "period_start", "value", "breach", "prev_breach",
                    state_of(F.col("breach"), F.col("prev_breach")).alias("state"))


def states_from_history(history: DataFrame, rule_df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """:func:`alarm_states` from a history (:func:`alarm_history`, or the one a stream keeps)."""
    return _states(history, rule_df, as_of)


def evaluation_range(as_of: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """``ts`` range of the points that decide the states at ``as_of``.

    Restrict the points to it (:func:`basalt.operators.metrics.in_range`)
    before the five-minute statistics: the filter reaches the scan, so the
    states at one time read two periods of points, not the whole history."""
    return covering_range(as_of - dt.timedelta(seconds=PERIOD_SECONDS * EVALUATION_PERIODS), as_of)


def alarm_states(stats: DataFrame, rule_df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The state of every rule at ``as_of`` from the two periods ending there.

    ``stats`` may cover any span; only periods starting in the two periods
    before ``as_of`` count (see :func:`evaluation_range` to read no more)."""
    return _states(rule_periods(_deciding(stats, as_of), rule_df), rule_df, as_of)


def _deciding(periods: DataFrame, as_of: dt.datetime) -> DataFrame:
    first = as_of - dt.timedelta(seconds=PERIOD_SECONDS * EVALUATION_PERIODS)
    return periods.where((F.col("period_start") >= F.lit(first)) & (F.col("period_start") < F.lit(as_of)))


def _states(per: DataFrame, rule_df: DataFrame, as_of: dt.datetime) -> DataFrame:
    per = _deciding(per, as_of)
    agg = per.groupBy("alarm").agg(F.count(F.lit(1)).alias("periods_with_data"),
                                   F.count_if(F.col("breach")).alias("breaching_periods"),
                                   F.max_by("value", "period_start").alias("last_value"))
    state = (F.when(F.coalesce("periods_with_data", F.lit(0)) == 0, F.lit(INSUFFICIENT))
             .when(F.col("breaching_periods") == EVALUATION_PERIODS, F.lit(ALARM)).otherwise(F.lit(OK)))
    return (rule_df.join(F.broadcast(agg), "alarm", "left")  # agg: at most one row per rule
            .select("alarm", "metric", "comparison", "threshold", "statistic",
                    F.coalesce("periods_with_data", F.lit(0)).cast("bigint").alias("periods_with_data"),
                    F.coalesce("breaching_periods", F.lit(0)).cast("bigint").alias("breaching_periods"),
                    "last_value", state.alias("state")))


def state_counts(states: DataFrame, name_filter: str | None = None) -> DataFrame:
    """Number of rules per state, optionally only rules whose name contains a text."""
    s = states.where(F.col("alarm").contains(name_filter)) if name_filter else states
    return s.groupBy("state").agg(F.count(F.lit(1)).alias("alarms"))
