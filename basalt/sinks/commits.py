"""Writes to several tables that become visible together (staged files and one commit record).

A run writes its files to ``<root>/_staging/<run>/<n>`` of each table it touches; names that
begin with an underscore are hidden from Spark's readers.  :meth:`StagedRun.commit` then

1. writes one small record that names all staged folders and moves it into
   ``<log>/_commits`` by a rename: from here on the run has happened;
2. removes the files that the run replaces, if any, and moves its own into their tables (Spark
   gives every file a name of its own, so a file that is already there needs no second move);
3. removes the record and the staging folders.

A driver that dies before 1 leaves nothing that any reader sees; one that dies later is
completed by :func:`recover`, which every run and reader of such tables calls first.  The
driver handles file names of one run only, as Spark's own job commit does.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

STAGING, COMMITS = "_staging", "_commits"


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """Paths below ``folder``, relative to it, without hidden files."""
    fs, root = file_system(spark, folder)
    if not fs.exists(root):
        return []
    base = fs.makeQualified(root).toString().rstrip("/") + "/"
    found, out = fs.listFiles(root, True), []
    while found.hasNext():
        relative = found.next().getPath().toString()[len(base):]
        if not any(part.startswith(("_", ".")) for part in relative.split("/")):
            out.append(relative)
    return sorted(out)


def move_files(spark: SparkSession, folder: str, root: str) -> int:
    """Move the files below ``folder`` to the same relative paths below ``root``; those already moved stay."""
    fs, _ = file_system(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    moved = 0
    for relative in files_below(spark, folder):
        source, target = path(f"{folder}/{relative}"), path(f"{root}/{relative}")
        if fs.exists(target):
            continue
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target) and not fs.exists(target):
            raise OSError(f"{source} could not be moved to {target}")
        moved += 1
    return moved


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def _publish(spark: SparkSession, record_path: str, record: dict) -> None:
    for path in record["replaced"]:
        _remove(spark, path)
    for root, folder in record["folders"]:
        move_files(spark, folder, root)
    _remove(spark, record_path)
    for folder in record["staging"]:
        _remove(spark, folder)


def _records(spark: SparkSession, log_root: str) -> list[str]:
    fs, p = file_system(spark, f"{log_root.rstrip('/')}/{COMMITS}")
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().endswith(".json"))


def recover(spark: SparkSession, log_root: str) -> int:
    """Finish the runs that are committed but not yet in place; returns how many there were."""
    records = _records(spark, log_root)
    for path in records:
        text = spark.read.text(path, wholetext=True).first()
        _publish(spark, path, json.loads(text["value"]))
    return len(records)


class StagedRun:
    """The files of one run: ``folder(root)`` gives a fresh staging folder of a table, ``add`` makes it part of
    the run (a failed attempt's folder is simply never added), ``commit`` makes all added ones visible."""

    def __init__(self, spark: SparkSession, log_root: str) -> None:
        self.spark, self.log_root, self.run = spark, log_root.rstrip("/"), uuid.uuid4().hex
        self.folders: list[tuple[str, str]] = []
        self.replaced: list[str] = []
        self.staging: set[str] = set()
        self._n = 0

    def folder(self, root: str) -> str:
        base = f"{root.rstrip('/')}/{STAGING}/{self.run}"
        self.staging.add(base)
        self._n += 1
        return f"{base}/{self._n}"

    def add(self, root: str, folder: str) -> None:
        self.folders.append((root.rstrip("/"), folder))

    def replace(self, files: list[str]) -> None:
        """Table files whose rows this run has staged anew, or leaves out: they go when it is committed."""
        self.replaced += files

    def record(self) -> tuple[str, dict]:
        """Write the commit record: a complete file under another name, then one rename."""
        content = {"run": self.run, "folders": self.folders, "replaced": self.replaced, "staging": sorted(self.staging)}
        final = f"{self.log_root}/{COMMITS}/{self.run}.json"
        fs, target = file_system(self.spark, final)
        _, draft = file_system(self.spark, f"{self.log_root}/{COMMITS}/.{self.run}.draft")
        fs.mkdirs(target.getParent())
        out = fs.create(draft, True)
        out.write(json.dumps(content).encode())
        out.close()
        if not fs.rename(draft, target):
            raise OSError(f"{final} could not be written")
        return final, content

    def commit(self) -> None:
        if self.folders:
            _publish(self.spark, *self.record())
        else:
            self.discard()

    def discard(self) -> None:
        """Remove what was staged and not committed."""
        for folder in self.staging:
            _remove(self.spark, folder)
