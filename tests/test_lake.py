"""CSV dialect, ledger, catalog and JSON edge cases."""

import duckdb

from basalt.operators import catalog, ingest, logs, messages
from basalt.sinks import writers
from basalt.sources import readers

ROWS = [(1, 'say "hi", you'), (2, "two\nlines"), (3, " blanks "), (4, None), (5, ""), (6, 'a\\"b,\\'), (7, "é;\t|")]


def test_csv_round_trip_and_standard_readers(spark, tmp_path):
    out = str(tmp_path / "csv")
    df = spark.createDataFrame(ROWS, "id long, text string")
    writers.write_csv(df.coalesce(1), out)
    assert sorted(map(tuple, readers.read_csv(spark, out, df.schema).collect())) == ROWS
    got = duckdb.execute(f"SELECT * FROM read_csv('{out}/*.csv', header = true, quote = '\"', escape = '\"', "
                         "columns = {'id': 'BIGINT', 'text': 'VARCHAR'}) ORDER BY id").fetchall()
    assert [(i, t or "") for i, t in got] == [(i, t or "") for i, t in ROWS]


def test_csv_keeps_rows_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('id,text\n1,"a ""b"" c"\nnot a number,b\n')
    rows = readers.read_csv(spark, str(path), spark.createDataFrame([], "id long, text string").schema,
                            corrupt_column="_corrupt").collect()
    assert rows[0]["text"] == 'a "b" c' and rows[0]["_corrupt"] is None and rows[1]["_corrupt"].startswith("not a number")


def test_nanoseconds_lose_nothing_but_the_last_three_digits(spark, tmp_path):
    out = str(tmp_path / "ns")
    base = 1_705_312_800_123_456_000
    spark.range(5000).selectExpr(f"{base}L + id * 999999937 AS ts").write.parquet(out)
    df = readers.read_parquet(spark, out, ["ts"])
    got = sorted(r["us"] for r in df.selectExpr("unix_micros(cast(ts AS timestamp)) AS us").collect())
    assert got == sorted((base + i * 999999937) // 1000 for i in range(5000))


def _raw(path, n):
    path.write_text("".join(f'{{"event_time": "2024-01-15T10:00:{i:02d}Z", "user_id": {i}, "action": "a"}}\n' for i in range(n)))


def test_ledger_skips_settled_files_and_sets_bad_ones_aside(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    _raw(raw / "a.jsonl", 5)
    (raw / "b.jsonl.gz").write_text("this is no gzip file")
    out, aside, ledger = (str(tmp_path / x) for x in ("lake", "aside", "ledger"))

    def run():
        return ingest.ingest_batch(spark, str(raw), out, aside, ledger_root=ledger).first()
    first = run()
    assert (first["files_read"], first["rows_read_ok"]) == (1, 5)
    again = run()
    assert (again["files_read"], again["rows_read_ok"]) == (0, 0)
    _raw(raw / "c.jsonl", 3)
    assert (run()["files_read"], spark.read.parquet(out).count()) == (1, 8)
    attempts = {(r["file"].rsplit("/", 1)[1], r["attempt"], r["status"]) for r in ingest.read_ledger(spark, ledger).collect()}
    assert {x for x in attempts if x[0] == "b.jsonl.gz"} == {("b.jsonl.gz", 1, "failed"), ("b.jsonl.gz", 2, "failed"),
                                                             ("b.jsonl.gz", 3, "set aside")}
    bad = [r for r in spark.read.parquet(aside).collect() if r["reason"] == "unreadable"]
    assert [r["attempts"] for r in bad] == [3]


def test_summary_counts_the_routes(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"user_id": 1, "action": "undated"}\n{"event_time": " ", "user_id": 2, "action": "blank"}\n'
                    '{"event_time": "2024-01-15T10:00:00Z", "user_id": 3, "action": "ok"}\n')
    s = ingest.ingest_batch(spark, str(path), str(tmp_path / "lake"), str(tmp_path / "q")).first()
    assert (s["rows_read_ok"], s["rows_dated"], s["rows_corrupt"]) == (2, 1, 1)
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 2 and spark.read.parquet(str(tmp_path / "q")).count() == 1


def test_second_root_and_quoted_location(spark, tmp_path):
    one, two = tmp_path / "it's one", tmp_path / "two"
    spark.range(3).write.parquet(str(one / "a"))
    spark.range(4).selectExpr("id", "'x' AS k").write.partitionBy("k").parquet(str(two / "b"))
    db = "two_roots"
    catalog.create_database(spark, db, str(tmp_path / "db"))
    catalog.discover_tables(spark, db, str(one))
    catalog.discover_tables(spark, db, str(two))
    assert {r["table"] for r in catalog.list_tables(spark, db).collect()} == {"a", "b"}
    assert spark.table(f"{db}.a").count() == 3 and spark.table(f"{db}.b").where("k = 'x'").count() == 4
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_body_kind_looks_at_the_whole_body(spark):
    bodies = ['{"k": 1}', '{"k": 1}}', '{"k": 1}{}', '{"k": 1}] }', "[1, 2]", "[1]]", "[1], [2]", '{"a": "}"}', " {} ", "[", "true", "true story"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [r[0] for r in df.select(messages.body_kind("body")).collect()]
    assert got == ["object", "text", "text", "text", "json", "text", "text", "object", "object", "text", "json", "text"]


def test_last_errors_of_several_files_are_in_time_order(spark, tmp_path):
    (tmp_path / "z.log").write_text("".join(f"2024-01-01 10:00:{i:02d} ERROR old {i}\n" for i in range(30)))
    (tmp_path / "a.log").write_text("".join(f"2024-01-02 10:00:{i:02d} ERROR new {i}\n" for i in range(30)))
    lines = logs.log_order(readers.read_logs(spark, str(tmp_path / "*.log")))
    got = [r["line"] for r in logs.last_errors(lines, 3, logs.LOG_ORDER).orderBy("n").collect()]
    assert got == [f"2024-01-02 10:00:{i} ERROR new {i}" for i in (27, 28, 29)]
