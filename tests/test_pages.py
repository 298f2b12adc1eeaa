"""Deep pages by a page index."""

import pytest
from pyspark.sql import functions as F

from basalt.operators import manifest as M


def test_a_page_deep_down_reads_one_or_two_files(spark, tmp_path):
    df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_000).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    path = str(tmp_path / "index")
    M.write_page_index(df, [F.desc("k")], path, file_rows=20_000)
    page = M.read_page(spark, path, 500_000 // 20 + 1, 20)
    assert 1 <= len(page.inputFiles()) <= 2
    rows = page.orderBy("row_no").collect()
    assert [(r["row_no"], r["k"]) for r in rows] == [(500_001 + i, 499_999 - i) for i in range(20)]
    assert {(r["total_rows"], r["total_pages"]) for r in rows} == {(1_000_000, 50_000)}
    assert not any("Exchange" in line for line in page._jdf.queryExecution().executedPlan().toString().splitlines())


@pytest.mark.parametrize("file_rows", [7, 1000])
def test_pages_cover_all_rows_once(spark, tmp_path, file_rows):
    df = spark.range(205).select((F.col("id") % 10).alias("a"), (F.col("id") * 37 % 205).alias("b"))
    path = str(tmp_path / "index")
    M.write_page_index(df.repartition(3), [F.asc("a"), F.asc("b")], path, file_rows=file_rows)
    got = [r for n in range(1, 23) for r in M.read_page(spark, path, n, 10).orderBy("row_no").collect()]
    want = sorted(tuple(r) for r in df.collect())
    assert [(r["a"], r["b"]) for r in got] == want and [r["row_no"] for r in got] == list(range(1, 206))
    same = M.page(df, 4, 10, [F.asc("a"), F.asc("b")])
    assert sorted(map(str, same.collect())) == sorted(map(str, M.read_page(spark, path, 4, 10).select(same.columns).collect()))


def test_pages_of_nothing(spark, tmp_path):
    path = str(tmp_path / "index")
    M.write_page_index(spark.range(0).toDF("a"), [F.asc("a")], path)
    assert M.read_page(spark, path, 1, 10).collect() == []
    with pytest.raises(ValueError, match="start at 1"):
        M.read_page(spark, path, 0, 10)
