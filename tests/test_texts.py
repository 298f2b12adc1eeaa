"""The whole-text query: a row per document, whatever its text and id; its files and their reader."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt import sinks
from basalt.plans import io_queries
from basalt.plans.io_queries import io_text_previews
from basalt.sources import readers

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def test_text_previews_has_a_row_per_document(spark, tmp_path):
    rows = [(1, "one"), (2, "two\nlines\n"), (3, ""), (4, None), (5, "\n"), (5, "again \u00e9"), (5, "again \u00e9"), (-6, "x\r\n"),
            (None, "no id"), (1001, "text")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = io_text_previews(spark, str(tmp_path))
    assert got.columns == ["doc_id", "text", "encoding", "size"]
    expected = [(i, t, "utf-8", None if t is None else len(t.encode())) for i, t in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_text_previews_keeps_id_and_size_of_a_text_with_nul_bytes(spark, tmp_path):
    spark.createDataFrame([(7, "a\x00b")], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert [tuple(r) for r in io_text_previews(spark, str(tmp_path)).collect()] == [(7, None, "binary", 3)]


def _below(root) -> dict[str, bytes]:
    return {os.path.relpath(f"{d}/{n}", root): open(f"{d}/{n}", "rb").read() for d, _, names in os.walk(root) for n in names}


def test_text_files_are_one_per_row_and_nothing_else(spark, tmp_path):
    texts = ["one", "", None, "two\nlines\n", "\u00e9", "one", "a\x00b"]
    df = spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)
    sinks.write_text_files(df, str(tmp_path / "out"))
    assert sorted(_below(tmp_path / "out").values()) == sorted(((t or "") + "\n").encode() for t in texts)


def test_text_files_of_no_row_leave_an_empty_folder(spark, tmp_path):
    sinks.write_text_files(spark.createDataFrame([], "value string"), str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") == [] and readers.read_text_files(spark, str(tmp_path / "out")).count() == 0


def test_text_files_of_a_failed_run_are_not_seen(spark, tmp_path):
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 39, F.raise_error(F.lit("no"))).otherwise("text").alias("value"))
    with pytest.raises(Exception, match="no"):
        sinks.write_text_files(bad, str(tmp_path / "out"))
    assert readers.read_text_files(spark, str(tmp_path / "out")).count() == 0


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    for i in range(2000):
        (tmp_path / f"{i}.txt").write_text(f"text {i}")
    files = readers.read_text_files(spark, str(tmp_path))
    assert files.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert {r["preview"] for r in files.select("preview").collect()} == {f"text {i}" for i in range(2000)}


def test_files_of_a_local_folder_are_those_of_binary_file(spark, tmp_path):
    names = ["a.txt", "with blank.txt", "b/c.txt", "b/d/e=1/f.txt", "_x=1/g.txt", "_metadata/m.txt", "\u00e9/h.txt", "b/empty.txt",
             "_hidden/i.txt", ".j", "b/_k.txt", "b/_l=1.txt", "m._COPYING_", "big.bin",
             "b/_common_metadata", "b/_n"]
    for n in names:
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_bytes(b"" if "empty" in n else b"\x00\xff" * 5_000_000 if "big" in n else n.encode("latin-1"))
    columns = ["path", "length", "modificationTime", "content"]
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).select(columns)
    got = readers._whole_files(spark, str(tmp_path), True)
    assert got.columns == columns and [f.dataType for f in got.schema] == [f.dataType for f in scan.schema]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, scan.collect()))
    assert got.count() == 9


def test_a_file_that_does_not_match_its_checksums_is_refused(spark, tmp_path):
    spark.createDataFrame([("x" * 2000,)], "value string").coalesce(1).write.text(str(tmp_path / "out"))
    assert [r["size"] for r in readers.read_text_files(spark, str(tmp_path / "out")).collect()] == [2001]
    part = next((tmp_path / "out").glob("part-*"))
    part.write_bytes(part.read_bytes().replace(b"x", b"y", 1))
    with pytest.raises(Exception, match="checksum error"):
        readers.read_text_files(spark, str(tmp_path / "out")).collect()


def test_text_previews_in_a_store_that_only_spark_reaches(spark, tmp_path, monkeypatch):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.texts.link./at", f"file://{tmp_path}")
    monkeypatch.setattr(io_queries, "scratch_dir", lambda *a: "viewfs://texts/at/out")
    rows = [(1, "one"), (2, None), (2, "two\nlines"), (None, "")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    expected = [(i, t, "utf-8", None if t is None else len(t.encode())) for i, t in rows]
    assert sorted(map(tuple, io_text_previews(spark, str(tmp_path)).collect()), key=repr) == sorted(expected, key=repr)
