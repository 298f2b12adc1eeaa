"""Golden tests for the reference defects whose fix changes a result."""

import datetime as dt
import os

from pyspark.sql import functions as F

from basalt.operators import explore, ingest, logs, messages, profile
from basalt.sources import readers


def test_d1_each_row_gets_its_own_date_partition(spark, tmp_path):
    raw = tmp_path / "two_days.jsonl"
    raw.write_text('{"event_time": "2024-01-15T23:59:59+00:00", "user_id": 1, "action": "login"}\n'
                   '{"event_time": "2024-01-16T00:00:01+00:00", "user_id": 2, "action": "logout"}\n')
    out = str(tmp_path / "lake")
    ingest.ingest_batch(spark, str(raw), out).collect()
    parts = sorted(p for p in os.listdir(tmp_path / "lake" / "year=2024" / "month=01"))
    assert parts == ["day=15", "day=16"]
    back = spark.read.parquet(out)
    assert back.where("day = '16'").count() == 1
    assert dict(back.dtypes)["month"] == "string"


def test_d5_bad_line_goes_to_quarantine(spark, tmp_path):
    raw = tmp_path / "bad_line.jsonl"
    raw.write_text('{"event_time": "2024-01-15T10:00:00Z", "user_id": 1, "action": "a"}\n'
                   '{"event_time": "2024-01-15T11:00:00Z", "user_id": 2, "action": "b"}\n'
                   '{"event_time": "2024-01-15T12:00:00Z", "user_id": \n'
                   '\n')
    summary = ingest.ingest_batch(spark, str(raw), str(tmp_path / "lake"), str(tmp_path / "q")).first()
    assert summary["rows_read_ok"] == 2 and summary["rows_corrupt"] == 1
    q = spark.read.parquet(str(tmp_path / "q"))
    assert q.count() == 1 and q.first()["raw"].startswith('{"event_time": "2024-01-15T12')
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 2


def test_d9_id_rule_precedence(spark):
    rows = [(i, i % 3, f"n{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, width_id long, name string")
    fixed = {r[0] for r in profile.id_columns(df).collect()}
    legacy = {r[0] for r in profile.id_columns(df, legacy_id_rule=True).collect()}
    assert fixed == {"id"}
    assert legacy == {"id", "width_id"}


def test_d10_empty_frame_is_safe(spark):
    df = spark.createDataFrame([], "a long, b string")
    s = {r["column"]: r for r in profile.column_summary(df).collect()}
    assert s["a"]["null_pct"] == 0.0 and s["a"]["distinct_pct"] == 0.0
    assert profile.empty_columns(df).count() == 0
    assert profile.quality_score(df).first()["score"] == 100.0


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    s = profile.column_summary(df).first()
    assert s["nulls"] == 2 and s["distinct"] == 1


def test_d12_search_without_hit_is_empty(spark):
    df = spark.createDataFrame([("alpha",), ("beta",)], "t string")
    assert explore.search(df, "zzz").count() == 0
    assert explore.search(df, "ALP").count() == 1


def test_d13_text_encodings(spark, tmp_path):
    (tmp_path / "u.txt").write_bytes("café".encode("utf-8"))
    (tmp_path / "l.txt").write_bytes("café".encode("latin-1"))
    (tmp_path / "n.bin").write_bytes(b"\x00\x01\x02abc")
    out = {os.path.basename(r["path"]): r for r in readers.read_text_files(spark, str(tmp_path)).collect()}
    assert out["u.txt"]["encoding"] == "utf-8" and out["u.txt"]["preview"] == "café"
    assert out["l.txt"]["encoding"] == "latin-1" and out["l.txt"]["preview"] == "café"
    assert out["n.bin"]["encoding"] == "binary" and out["n.bin"]["hex_head"] == "000102616263"


def test_d18_d22_message_targets(spark):
    rows = [("1", '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"raw/a+b%2Bc.jsonl"}}}]}'),
            ("2", '{"kind":"custom"}'),
            ("3", "  raw/x.jsonl "),
            ("4", '{"key":"raw/y.jsonl"}')]
    df = spark.createDataFrame(rows, "message_id string, body string")
    out = {r["message_id"]: r for r in messages.resolve_target(df, "dflt").collect()}
    assert (out["1"]["bucket"], out["1"]["key"]) == ("b", "raw/a b+c.jsonl")
    assert out["2"]["resolved"] is False and out["2"]["key"] is None
    assert (out["3"]["bucket"], out["3"]["key"]) == ("dflt", "raw/x.jsonl")
    assert (out["4"]["bucket"], out["4"]["key"]) == ("dflt", "raw/y.jsonl")


def test_d26_both_log_formats_parse(spark):
    df = spark.createDataFrame([("2024-01-30 10:00:00 ERROR w boom",), ("2024-01-30 10:00:00,123 - w - ERROR - x",),
                                ("Traceback ERROR",), ("2024-01-28 10:00:00 ERROR old",)], "line string")
    got = logs.recent_errors(df, dt.datetime(2024, 1, 31), 24).collect()
    assert len(got) == 3
    assert sum(1 for r in got if r["log_ts"] is None) == 1


def test_d7_recent_processed_looks_at_every_file(spark):
    from basalt.operators import manifest
    base = dt.datetime(2024, 1, 1)
    # 60 processed keys; the newest sort last by key, beyond the first 50
    rows = [(f"processed/events/f{i:03d}.parquet", 1024, base + dt.timedelta(hours=i), "processed") for i in range(60)]
    df = spark.createDataFrame(rows, "key string, size long, modified timestamp, source string")
    got = [r["key"] for r in manifest.recent_processed(df, 5).collect()]
    assert got == [f"processed/events/f{i:03d}.parquet" for i in (59, 58, 57, 56, 55)]


def test_d11_value_filter_and_search_are_anded(spark):
    rows = [(1, "red", "apple pie"), (2, "red", "plum"), (3, "blue", "apple"), (4, "red", "Apple tart")]
    df = spark.createDataFrame(rows, "id long, colour string, text string")
    got = explore.explore(df, {"colour": ["red"]}, "apple", 1, 20, [F.asc("id")])
    assert [r["id"] for r in got.collect()] == [1, 4]


def test_d14_mean_time_is_weighted_by_samples(spark):
    from basalt.operators import metrics
    stats = spark.createDataFrame([("ProcessingTime", 10.0, 10.0, 1), ("ProcessingTime", 20.0, 5.0, 4)],
                                  "metric string, sum double, average double, samples long")
    r = metrics.key_figures(stats).first()
    assert r["mean_time"] == 6.0 and r["mean_time_unweighted"] == 7.5


def test_d16_text_result_shows_twenty_data_rows(spark):
    from basalt.operators import sql
    df = spark.createDataFrame([(i, None if i == 0 else f"v{i}") for i in range(25)], "n long, v string")
    rows = sql.as_text(df, sql.TEXT_ROW_CAP, order=[F.asc("n")]).collect()
    assert len(rows) == 20 and rows[0]["v"] == "NULL" and rows[0]["rows_left"] == 5


def test_d17_redrive_policy_is_json_text(spark):
    attrs = spark.createDataFrame([({"ApproximateNumberOfMessages": "7",
                                     "RedrivePolicy": '{"deadLetterTargetArn":"arn:q","maxReceiveCount":"5"}'},)],
                                  "attributes map<string,string>")
    r = messages.queue_attributes(attrs).first()
    assert r["messages_available"] == 7 and r["messages_in_flight"] == 0 and r["max_receive_count"] == "5"


def test_d23_delayed_messages_are_counted_apart(spark):
    df = spark.createDataFrame([("available",), ("delayed",), ("delayed",), ("in_flight",)], "status string")
    r = messages.queue_depth(df).first()
    assert (r["messages_available"], r["messages_in_flight"], r["messages_delayed"]) == (1, 1, 2)


def test_d25_shared_store_lists_each_file_once(spark, tmp_path):
    from basalt.sources import listing
    for rel in ("raw/events/incoming/a.jsonl", "raw/events/incoming/b.jsonl", "processed/events/c.parquet"):
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    root = str(tmp_path)
    m = listing.list_store(spark, root, root, "processed/events/")
    got = sorted((r["key"], r["source"]) for r in m.collect())
    assert got == [("processed/events/c.parquet", "processed"), ("raw/events/incoming/a.jsonl", "raw"),
                   ("raw/events/incoming/b.jsonl", "raw")]


def test_m1_body_kind_edges(spark):
    bodies = [("a", '{"k": 1}'), ("b", ' \n {"k": 1}'), ("c", "[1, 2]"), ("d", ' "s"'), ("e", "-3.5"),
              ("f", "true"), ("g", "true story"), ("h", "raw/x.jsonl"), ("i", "{broken"), ("j", "null"),
              ("k", '{"k": 1} x'), ("l", "[1, 2] x"), ("m", '"s" x'), ("n", "12 ab"), ("o", '"a\\"b"'), ("p", "1e5")]
    df = spark.createDataFrame(bodies, "id string, body string")
    got = {r["id"]: r["k"] for r in df.select("id", messages.body_kind("body").alias("k")).collect()}
    assert got == {"a": "object", "b": "object", "c": "json", "d": "json", "e": "json", "f": "json",
                   "g": "text", "h": "text", "i": "text", "j": "json", "k": "text", "l": "text", "m": "text",
                   "n": "text", "o": "json", "p": "json"}


def test_d25_separate_stores_keep_their_labels(spark, tmp_path):
    from basalt.sources import listing
    for rel in ("raw/in/a.jsonl", "proc/processed/events/c.parquet", "proc/other/d.parquet"):
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    m = listing.list_store(spark, str(tmp_path / "raw"), str(tmp_path / "proc"), "processed/events/")
    got = sorted((r["key"], r["source"]) for r in m.collect())
    assert got == [("in/a.jsonl", "raw"), ("processed/events/c.parquet", "processed")]
