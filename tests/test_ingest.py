"""Ingest as one commit: faults after each step, files of bad rows only, batches of unreadable files."""

import pytest

from basalt.operators import ingest
from basalt.sinks import commits, writers

GOOD = '{{"event_time": "2024-01-{d:02d}T10:00:00Z", "user_id": {i}, "action": "a"}}\n'


class Roots:
    def __init__(self, spark, tmp_path):
        self.spark, self.raw = spark, tmp_path / "raw"
        self.raw.mkdir()
        self.lake, self.aside, self.ledger = (str(tmp_path / x) for x in ("lake", "aside", "ledger"))

    def file(self, name, good=(), bad=0):
        (self.raw / name).write_text("".join(GOOD.format(d=i % 3 + 1, i=i) for i in good) + '{"event_time": "2024\n' * bad)

    def ingest(self, **more):
        return self.spark.createDataFrame(
            ingest.ingest_batch(self.spark, str(self.raw), self.lake, self.aside, ledger_root=self.ledger, **more).collect()).first()

    def users(self):
        return sorted(r["user_id"] for r in ingest.read_lake(self.spark, self.lake, self.ledger).collect())

    def quarantined(self):
        return sorted((r["file"].rsplit("/", 1)[1], r["reason"]) for r in self.spark.read.parquet(self.aside).collect())

    def statuses(self):
        return sorted((r["file"].rsplit("/", 1)[1], r["attempt"], r["status"])
                      for r in ingest.read_ledger(self.spark, self.ledger).collect())


@pytest.fixture()
def roots(spark, tmp_path):
    return Roots(spark, tmp_path)


class Dead(BaseException):
    """The driver dies: no handler of the library runs."""


def _dies_at(monkeypatch, module, name, call):
    real, calls = getattr(module, name), []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == call:
            raise Dead(name)
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, failing)


STEPS = [(ingest, "quarantine_rows", 1),  # lake rows staged
         (ingest, "_stage_log", 1),  # lake and quarantine staged
         (commits.StagedRun, "record", 1),  # everything staged, nothing committed
         (commits, "_publish", 1),  # committed, nothing in place
         (commits, "move_files", 2), (commits, "move_files", 3),  # some tables in place
         (commits, "_remove", 1),  # all in place, the record still there
         (commits, "_remove", 2)]  # record gone, staging folders still there


@pytest.mark.parametrize(("module", "name", "call"), STEPS, ids=[f"{n}-{c}" for _, n, c in STEPS])
def test_every_row_once_after_a_death_at_any_step(roots, monkeypatch, module, name, call):
    roots.file("a.jsonl", range(5), bad=2)
    roots.file("b.jsonl", range(5, 9))
    with monkeypatch.context() as m:
        _dies_at(m, module, name, call)
        with pytest.raises(Dead):
            roots.ingest()
    roots.file("c.jsonl", [20], bad=1)
    roots.ingest()
    assert roots.users() == [*range(9), 20]
    assert roots.quarantined() == [("a.jsonl", "unparseable")] * 2 + [("c.jsonl", "unparseable")]
    assert roots.statuses() == [("a.jsonl", 1, "done"), ("b.jsonl", 1, "done"), ("c.jsonl", 1, "done")]
    assert commits._records(roots.spark, roots.ledger) == []
    again = roots.ingest()
    assert (again["files_read"], roots.users()) == (0, [*range(9), 20])


def test_rename_half_done_is_completed(roots, monkeypatch):
    for i in range(6):
        roots.file(f"{i}.jsonl", range(3 * i, 3 * i + 3))
    real = commits.files_below
    with monkeypatch.context() as m:
        m.setattr(commits, "files_below", lambda spark, folder: real(spark, folder)[:1])
        _dies_at(m, commits, "_remove", 1)
        with pytest.raises(Dead):
            roots.ingest()
    assert roots.users() == list(range(18))  # the reader completes the run


def test_failing_quarantine_write_doubles_nothing(roots, monkeypatch):
    roots.file("a.jsonl", range(2), bad=1)
    roots.file("b.jsonl", range(2, 4), bad=1)
    real, calls = ingest.quarantine_rows, []

    def once(*args, **kwargs):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("no space")
        return real(*args, **kwargs)

    monkeypatch.setattr(ingest, "quarantine_rows", once)
    s = roots.ingest()
    assert (s["files_read"], s["rows_read_ok"], s["rows_corrupt"]) == (2, 4, 2)
    assert roots.users() == [0, 1, 2, 3] and len(roots.quarantined()) == 2


def test_files_of_bad_rows_only(roots):
    roots.file("a.jsonl", bad=3)
    roots.file("b.jsonl", bad=1)
    s = roots.ingest()
    assert (s["files_read"], s["rows_read_ok"], s["rows_dated"], s["rows_corrupt"]) == (2, 0, 0, 4)
    assert roots.quarantined() == [("a.jsonl", "unparseable")] * 3 + [("b.jsonl", "unparseable")]
    assert [x[2] for x in roots.statuses()] == ["done", "done"]


def test_bad_rows_only_without_ledger(roots):
    roots.file("a.jsonl", bad=2)
    s = ingest.ingest_batch(roots.spark, str(roots.raw), roots.lake, roots.aside).first()
    assert (s["rows_read_ok"], s["rows_corrupt"]) == (0, 2) and len(roots.quarantined()) == 2


def test_batch_of_missing_files_is_set_aside(roots):
    gone = [str(roots.raw / f"gone{i}.jsonl") for i in range(3)]
    for want in (0, 0):  # the second run finds them settled
        s = ingest.ingest_batch(roots.spark, gone, roots.lake, roots.aside, ledger_root=roots.ledger, max_attempts=2).first()
        assert s["files_read"] == want
    assert roots.statuses() == [(f"gone{i}.jsonl", a, s) for i in range(3) for a, s in ((1, "failed"), (2, "set aside"))]
    assert roots.quarantined() == [(f"gone{i}.jsonl", "unreadable") for i in range(3)]


def test_a_lake_that_cannot_be_written_settles_nothing(roots, monkeypatch):
    roots.file("a.jsonl", range(2))
    roots.file("b.jsonl", range(2, 4))
    with monkeypatch.context() as m:
        m.setattr(ingest, "transform_for_lake", lambda *a, **k: (_ for _ in ()).throw(OSError("read-only")))
        with pytest.raises(OSError, match="read-only"):
            roots.ingest(max_attempts=2)
    assert {x[2] for x in roots.statuses()} == {"failed"}
    assert roots.ingest()["files_read"] == 2 and roots.users() == [0, 1, 2, 3]


def test_one_bad_file_among_many(roots):
    for i in range(9):
        roots.file(f"{i}.jsonl", [i])
    (roots.raw / "5.jsonl").unlink()
    (roots.raw / "5.jsonl.gz").write_text("no gzip file")
    s = roots.ingest(max_files=4)
    assert s["files_read"] == 8 and roots.users() == [0, 1, 2, 3, 4, 6, 7, 8]
    assert [x for x in roots.statuses() if x[0] == "5.jsonl.gz"][-1] == ("5.jsonl.gz", 3, "set aside")


@pytest.mark.parametrize("empty", ["plan", "run time"])
def test_writers_of_empty_frames_return_false(spark, tmp_path, empty):
    df = spark.createDataFrame([("a", "2024", "01", "02")], "v string, year string, month string, day string")
    df = df.limit(0) if empty == "plan" else df.join(df.where("v = 'b'").select("v"), "v")
    assert writers.write_partitioned(df, str(tmp_path / "parts")) is False
    assert writers.write_parquet(df, str(tmp_path / "plain")) is False
    assert writers.write_partitioned(spark.createDataFrame([("a", "1", "2", "3")], df.schema), str(tmp_path / "parts")) is True


def test_a_file_written_again_replaces_its_rows(roots):
    roots.file("a.jsonl", range(6), bad=2)
    roots.file("b.jsonl", range(6, 10), bad=1)
    roots.ingest(replace_changed=True)
    roots.file("a.jsonl", [0, 1, 50], bad=1)  # rows gone, a row added, one bad line less
    s = roots.ingest(replace_changed=True)
    assert (s["files_read"], s["rows_read_ok"]) == (1, 3)
    assert roots.users() == [0, 1, 6, 7, 8, 9, 50]
    assert roots.quarantined() == [("a.jsonl", "unparseable"), ("b.jsonl", "unparseable")]
    assert roots.ingest(replace_changed=True)["files_read"] == 0
    assert {r["source_file"].rsplit("/", 1)[1] for r in ingest.read_lake(roots.spark, roots.lake, roots.ledger).collect()} == {"a.jsonl", "b.jsonl"}


def test_a_file_written_again_without_good_rows(roots):
    roots.file("a.jsonl", range(3))
    roots.file("b.jsonl", range(3, 5))
    roots.ingest(replace_changed=True)
    roots.file("a.jsonl", bad=1)
    roots.ingest(replace_changed=True)
    assert roots.users() == [3, 4] and roots.quarantined() == [("a.jsonl", "unparseable")]


@pytest.mark.parametrize(("name", "call"), [("move_files", 1), ("move_files", 2), ("_remove", 1), ("_remove", 2)])
def test_replacing_survives_a_death(roots, monkeypatch, name, call):
    roots.file("a.jsonl", range(6))
    roots.file("b.jsonl", range(6, 10))
    roots.ingest(replace_changed=True)
    roots.file("a.jsonl", [0, 60])
    with monkeypatch.context() as m:
        _dies_at(m, commits, name, call)
        with pytest.raises(Dead):
            roots.ingest(replace_changed=True)
    assert roots.users() == [0, 6, 7, 8, 9, 60]
    assert roots.ingest(replace_changed=True)["files_read"] == 0


def test_without_replacing_a_changed_file_stays_settled(roots):
    roots.file("a.jsonl", range(2))
    roots.ingest()
    roots.file("a.jsonl", range(5))
    assert roots.ingest()["files_read"] == 0 and roots.users() == [0, 1]
