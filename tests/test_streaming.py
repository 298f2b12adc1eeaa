"""availableNow streams over a temp folder: a bad line goes to quarantine, a
second run over the same files adds nothing, a new file is picked up, and
the streamed table equals the batch ingest of the same files."""

import datetime as dt

import pytest

from basalt.operators import ingest
from basalt.plans import stream_queries
from basalt.streaming import streams


def _lines(day, n, start=0):
    return "".join(f'{{"event_time": "2024-01-{day:02d}T10:{i % 60:02d}:00Z", "user_id": {start + i}, '
                   f'"action": "a{i % 3}"}}\n' for i in range(n))


def test_stream_equals_batch_and_is_idempotent(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "f1.jsonl").write_text(_lines(15, 20) + '{"event_time": "2024-01-15T11:00:00Z", "user_id": \n')
    (raw / "f2.jsonl").write_text(_lines(16, 10, 100))
    out, q_dir, ck = str(tmp_path / "lake"), str(tmp_path / "quarantine"), str(tmp_path / "ck")
    for _ in range(2):  # the second run finds no new files
        for q in streams.start_ingest(spark, str(raw), out, q_dir, ck):
            q.awaitTermination()
    lake = spark.read.parquet(out)
    assert lake.count() == 30
    assert spark.read.parquet(q_dir).count() == 1
    assert {r["day"] for r in lake.select("day").distinct().collect()} == {"15", "16"}

    (raw / "f3.jsonl").write_text(_lines(17, 5, 200))
    for q in streams.start_ingest(spark, str(raw), out, q_dir, ck):
        q.awaitTermination()
    lake = spark.read.parquet(out)
    assert lake.count() == 35

    batch_out = str(tmp_path / "batch")
    ingest.ingest_batch(spark, str(raw), batch_out)
    cols = ["event_time", "user_id", "action", "year", "month", "day"]
    a = sorted(tuple(r) for r in lake.select(*cols).collect())
    b = sorted(tuple(r) for r in spark.read.parquet(batch_out).select(*cols).collect())
    assert a == b


def test_handler_rejection_fails_the_batch(spark, tmp_path):
    raw = tmp_path / "r"
    raw.mkdir()
    (raw / "a.jsonl").write_text(_lines(15, 3))
    stream = streams.raw_event_stream(spark, str(raw))
    q = streams.start_with_handler(stream, lambda batch, epoch: False, str(tmp_path / "ck"))
    try:
        q.awaitTermination()
        failed = False
    except Exception:
        failed = True
    assert failed


def _batches(stream, checkpoint):
    """(rows, tasks) of every micro-batch of a stream."""
    seen = []

    def handler(batch, epoch_id):
        seen.append((batch.count(), batch.rdd.getNumPartitions()))
        return True

    streams.start_with_handler(stream, handler, str(checkpoint)).awaitTermination()
    return seen


@pytest.fixture
def events(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(seconds=i), i % 7, "view", float(i % 50), None) for i in range(2000)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_a_micro_batch_of_events_is_shared_by_tasks(spark, events, tmp_path):
    seen = _batches(stream_queries._events_stream(spark, events), tmp_path / "ck")
    assert sum(rows for rows, _ in seen) == 2000 and len(seen) == 6
    assert min(tasks for _, tasks in seen) > 1


def test_a_micro_batch_of_points_is_shared_by_tasks(spark, events, tmp_path, monkeypatch):
    seen = []
    start = streams.start_alarms

    def watched(points, *rest):
        seen.extend(_batches(points, tmp_path / "ck"))
        return start(points, *rest)

    monkeypatch.setattr(stream_queries.STR, "start_alarms", watched)
    history = stream_queries.stream_alarm_history(spark, events)
    assert history.count() > 0 and len(seen) == 6
    assert min(tasks for _, tasks in seen) > 1
