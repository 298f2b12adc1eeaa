"""Streams with an acknowledgement per message, dedupe by state over many batches, and draining."""

from pyspark.sql import functions as F

from basalt.streaming import streams as S

SCHEMA = "k string, n long"


def _write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def _stream(spark, folder, files=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(str(folder))


def test_dedupe_over_20_batches_reads_only_new_rows(spark, tmp_path):
    raw, out, ck = (str(tmp_path / x) for x in ("raw", "out", "ck"))
    batches = [[(f"k{(b * 7 + i) % 60}", b * 100 + 99 - i) for i in range(20)] + [("hot", b * 100 + 50), (None, b)] for b in range(20)]
    per_batch = []
    for rows in batches:  # a restart before every batch
        _write(spark, raw, rows)
        q = S.start_deduping(_stream(spark, raw), ["k"], ["n"], out, ck)
        q.awaitTermination()
        per_batch += [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    want = {}
    for rows in batches:  # first by arrival, then the least n
        for k in {k for k, _ in rows} - set(want):
            want[k] = min(n for key, n in rows if key == k)
    got = [(r["k"], r["n"]) for r in S.read_table(spark, out, spark.createDataFrame([], SCHEMA).schema).collect()]
    assert len(got) == len(want) and dict(got) == want
    assert per_batch == [22] * 20  # no batch reads what earlier ones wrote


def test_dedupe_plan_reads_no_table(spark, tmp_path):
    raw, out, ck = (str(tmp_path / x) for x in ("raw", "out", "ck"))
    _write(spark, raw, [("a", 1)])
    S.start_deduping(_stream(spark, raw), ["k"], ["n"], out, ck).awaitTermination()
    _write(spark, raw, [("a", 0), ("b", 2)])
    q = S.start_deduping(_stream(spark, raw), ["k"], ["n"], out, ck)
    q.awaitTermination()
    assert len(q.recentProgress[-1]["sources"]) == 1 and q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 2


def _calls(spark, out):
    return sorted((r["n"], r["attempts"], r["outcome"])
                  for r in S.read_outcomes(spark, out, spark.createDataFrame([], SCHEMA).schema).collect())


def test_worker_repeats_only_what_the_handler_refused(spark, tmp_path):
    raw, out, ck = (str(tmp_path / x) for x in ("raw", "out", "ck"))

    def handler(m):
        if m["n"] == 4 and m["attempts"] < 2:
            raise ValueError("an exception refuses the message too")
        return m["n"] % 10 != 0

    for part in ([0, 1, 2], [3, 4, 5], [10, 11]):
        _write(spark, raw, [(f"m{n}", n) for n in part])
        S.start_worker(_stream(spark, raw), handler, out, ck).awaitTermination()
    assert _calls(spark, out) == sorted(
        [(n, 1, "accepted") for n in (1, 2, 3, 5, 11)] + [(0, 1, "rejected"), (0, 2, "rejected"), (0, 3, "set aside")]
        + [(4, 1, "rejected"), (4, 2, "rejected"), (10, 1, "rejected")])
    assert S.retry_rejected(spark, handler, out, spark.createDataFrame([], SCHEMA).schema) == 2
    after = _calls(spark, out)
    assert [c for c in after if c[0] == 4][-1] == (4, 3, "accepted") and [c for c in after if c[0] == 10][-1] == (10, 3, "set aside")
    assert S.retry_rejected(spark, handler, out, spark.createDataFrame([], SCHEMA).schema) == 0
    _write(spark, raw, [("m20", 21)])
    S.start_worker(_stream(spark, raw), handler, out, ck).awaitTermination()
    assert _calls(spark, out) == sorted([*after, (21, 1, "accepted")])  # nothing that is settled comes back


def test_worker_batch_that_failed_replaces_its_outcomes(spark, tmp_path, monkeypatch):
    raw, out, ck = (str(tmp_path / x) for x in ("raw", "out", "ck"))
    _write(spark, raw, [("a", 1), ("b", 2)])
    real = S.outcomes
    with monkeypatch.context() as m:
        m.setattr(S, "outcomes", lambda *a: real(*a).withColumn("n", F.raise_error(F.lit("lost")).cast("long")))
        q = S.start_worker(_stream(spark, raw), lambda m: True, out, ck)
        try:
            q.awaitTermination()
        except Exception as exc:  # noqa: BLE001
            assert "lost" in str(exc)
    S.start_worker(_stream(spark, raw), lambda m: True, out, ck).awaitTermination()
    assert _calls(spark, out) == [(1, 1, "accepted"), (2, 1, "accepted")]


def test_drain_goes_on_until_nothing_comes(spark, tmp_path):
    raw, out, ck = (str(tmp_path / x) for x in ("raw", "out", "ck"))
    _write(spark, raw, [("a", i) for i in range(5)])
    polls = []

    def start():
        if len(polls) == 1:
            _write(spark, raw, [("b", i) for i in range(3)])
        polls.append(1)
        return S.start_worker(_stream(spark, raw), lambda m: True, out, ck)

    assert S.drain(start, max_empty_polls=2) == 8 and len(polls) == 4
    assert len(_calls(spark, out)) == 8


def test_stream_alarms_equal_the_batch_for_any_order(spark, tmp_path):
    import datetime as dt
    import random

    from basalt.operators import alarms as A
    from basalt.operators import metrics as X

    rng = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    rows = [(m, float(rng.randint(0, 12)), base + dt.timedelta(seconds=rng.randint(0, 7200))) for m in ("a", "b") for _ in range(60)]
    rules = A.rules(spark, [("sum", "a", A.GREATER, 8.0, "Sum"), ("low", "a", A.LESS, 5.0, "Average"),
                            ("max", "b", "GreaterThanOrEqualToThreshold", 9.0, "Maximum"), ("n", "b", A.GREATER, 1.0, "SampleCount"),
                            ("none", "c", A.GREATER, 0.0, "Sum")])
    schema = "metric string, value double, ts timestamp_ntz"
    rng.shuffle(rows)
    raw, out, ck = (str(tmp_path / x) for x in ("raw", "out", "ck"))
    for i in range(4):  # a restart before every batch; each holds points of all times
        part = rows[30 * i:30 * i + 30]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(raw)
        stream = spark.readStream.schema(schema).parquet(raw)
        S.start_alarms(stream, rules, out, ck).awaitTermination()
        stats = X.five_minute_stats(spark.createDataFrame(rows[:30 * i + 30], schema))
        want = {tuple(r) for r in A.alarm_history(stats, rules).collect()}
        history = S.read_alarm_history(spark, out)
        assert {tuple(r) for r in history.collect()} == want
        at = base + dt.timedelta(hours=1)
        assert sorted(map(tuple, A.states_from_history(history, rules, at).collect()), key=str) == sorted(
            map(tuple, A.alarm_states(stats, rules, at).collect()), key=str)


def test_handler_sees_plain_values(spark):
    df = spark.createDataFrame([(None, 1), ("a", None)], SCHEMA).withColumn("attempts", F.lit(0))

    def handler(m):
        return m["n"] is None if m["k"] == "a" else type(m["n"]) is int and m["k"] is None and m["attempts"] == 0

    assert [r["outcome"] for r in S.outcomes(df, handler, 3).collect()] == ["accepted", "accepted"]
