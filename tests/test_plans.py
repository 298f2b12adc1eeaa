"""Plan-shape checks: built-in expressions only, bounded windows, pushed filters."""

import pytest

import __spark_entry__ as entry
from basalt.operators import profile
from basalt.plans import views as V
from basalt.plans.registry import QUERIES, load_all

load_all()
REFERENCE = sorted(QUERIES)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REFERENCE)
def test_no_python_udf_in_plans(spark, sf_dir, name):
    if name.startswith("lake_ingest") or name.startswith("stream_") or name.startswith("io_") or \
            name.startswith("catalog_"):
        pytest.skip("writes data when built")
    plan = _plan(entry.queries()[name](spark, sf_dir))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_top_values_uses_partial_group_limit(spark, sf_dir):
    df = profile.top_values(V.table(spark, sf_dir, "customer"), 5)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_partition_filter_reaches_scan(spark, tmp_path):
    from basalt.sources.listing import read_partition
    df = spark.range(10).selectExpr("id", "'2024' AS year", "lpad(cast(id % 2 + 1 AS string), 2, '0') AS month",
                                    "'01' AS day")
    df.write.partitionBy("year", "month", "day").parquet(str(tmp_path / "t"))
    q = read_partition(spark, str(tmp_path / "t"), "2024", "02")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert q.count() == 5


BOUNDED_MARKERS = ("Limit", "TakeOrderedAndProject", "_pid")
AGGREGATES = ("HashAggregate", "SortAggregate", "ObjectHashAggregate")


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


def _unbounded_global_windows(plan: str) -> list[str]:
    """Single-partition exchanges (what an unpartitioned window, sort or limit
    needs) whose input is neither a partial aggregate (one row per task) nor
    visibly bounded by a limit / top-k / per-partition offsets."""
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        depth = _depth(line)
        subtree = []
        for nxt in lines[i + 1:]:
            if _depth(nxt) <= depth:
                break
            subtree.append(nxt)
        child = subtree[0].lstrip(" :+-") if subtree else ""
        if child.startswith(AGGREGATES):
            continue
        if not any(m in s for s in subtree for m in BOUNDED_MARKERS):
            bad.append(line.strip()[:160])
    return bad


@pytest.mark.parametrize("name", REFERENCE)
def test_no_global_window_over_unbounded_input(spark, sf_dir, name):
    if name.startswith(("lake_ingest", "stream_", "io_", "catalog_", "ingest_quarantine")):
        pytest.skip("writes data when built")
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert _unbounded_global_windows(plan) == []


@pytest.mark.parametrize("name", REFERENCE)
def test_no_interpreted_lambda_in_plans(spark, sf_dir, name):
    """Higher-order functions (``filter``/``transform`` with a lambda) run
    outside whole-stage codegen; none may sit in a registered query's plan."""
    if name.startswith(("lake_ingest", "stream_", "io_", "catalog_", "ingest_quarantine")):
        pytest.skip("writes data when built")
    plan = _plan(entry.queries()[name](spark, sf_dir))
    assert "lambdafunction" not in plan


def test_alarm_states_scan_reads_two_periods(spark, sf_dir):
    df = entry.queries()["alarm_states"](spark, sf_dir)
    plan = _plan(df)
    assert "GreaterThanOrEqual(ts,2024-01-30T11:50)" in plan and "LessThan(ts,2024-01-30T12:00)" in plan


def test_time_filter_on_points_reaches_scan(spark, sf_dir):
    plan = _plan(entry.queries()["metric_last_hours"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00)" in plan


@pytest.mark.parametrize("name", ["alarm_states", "profile_column_summary", "profile_describe"])
def test_bounded_side_is_broadcast(spark, sf_dir, name):
    """Joins of one-row-per-rule/column tables broadcast the bounded aggregate
    (the preserved side of a left join cannot be the broadcast side)."""
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_message_bodies_parsed_once_under_a_filter(spark, sf_dir):
    """The resolved filter must not copy the JSON parses below the parse step."""
    from basalt.operators import messages
    msgs = V.messages(V.table(spark, sf_dir, "events"))
    df = messages.resolve_target(msgs, "b").where("resolved").select("bucket", "key")
    plan = _plan(df)
    assert plan.count("from_json") == 1
