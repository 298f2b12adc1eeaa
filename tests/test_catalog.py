"""Tables that follow their files, refusals, and session views beside tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.operators import catalog, sql


@pytest.fixture()
def lake(spark, tmp_path):
    db = "follow_" + tmp_path.name.replace("-", "_").lower()[:40]
    catalog.create_database(spark, db, str(tmp_path / "db"))
    (tmp_path / "lake").mkdir()

    class Lake:
        name, root = db, str(tmp_path / "lake")

        def write(self, df, table="t", by=None):
            w = df.write.mode("append")
            (w.partitionBy(by) if by else w).parquet(f"{self.root}/{table}")

        def discover(self, **more):
            return {r["table"]: (r["action"], r["detail"]) for r in catalog.discover_tables(spark, db, self.root, **more).collect()}

        def rows(self, table="t"):
            return sorted((tuple(r) for r in spark.table(f"{db}.{table}").collect()), key=str)

    yield Lake()
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_added_column_is_read_by_value(spark, lake):
    lake.write(spark.createDataFrame([(1, "a")], "id int, s string"))
    assert lake.discover() == {"t": ("created", None)}
    lake.write(spark.createDataFrame([("b", 2, 2.5)], "s string, id int, x double"))
    assert lake.discover() == {"t": ("altered", "added x")}
    assert lake.rows() == [(1, "a", None), (2, "b", 2.5)]
    assert lake.discover() == {"t": ("updated", None)}


def test_added_column_of_a_partitioned_table(spark, lake):
    lake.write(spark.createDataFrame([(1, "01")], "id long, month string"), by="month")
    lake.discover()
    lake.write(spark.createDataFrame([(2, "x", "02"), (3, "y", "01")], "id long, s string, month string"), by="month")
    assert lake.discover() == {"t": ("altered", "added s")}
    assert lake.rows() == [(1, None, "01"), (2, "x", "02"), (3, "y", "01")]


def test_widened_columns_are_read_by_value(spark, lake):
    before = "a tinyint, b int, c float, d int, e decimal(5,2), f date, g struct<x: int>, h array<int>"
    after = "a int, b bigint, c double, d double, e decimal(9,4), f timestamp_ntz, g struct<x: bigint, y: string>, h array<bigint>"
    row = spark.range(1).selectExpr("7Y a", "8 b", "1.5F c", "9 d", "cast(1.25 as decimal(5,2)) e", "date'2024-01-02' f",
                                    "named_struct('x', 3) g", "array(1, 2) h")
    wide = spark.range(1).selectExpr("70000 a", "8000000000L b", "2.5D c", "9.5D d", "cast(12345.6789 as decimal(9,4)) e",
                                     "timestamp_ntz'2024-01-02 03:04:05' f", "named_struct('x', 3000000000L, 'y', 'z') g", "array(3000000000L) h")
    assert row.schema.simpleString() == "struct<" + before.replace(": ", ":").replace(", ", ",").replace(" ", ":") + ">"
    lake.write(row)
    lake.discover()
    lake.write(wide)
    action, detail = lake.discover()["t"]
    assert (action, detail) == ("altered", "widened a, b, c, d, e, f, g, h")
    table = spark.table(f"{lake.name}.t")
    assert table.schema.simpleString() == wide.schema.simpleString()
    got = table.orderBy("a").select("a", "b", "c", "d", F.col("e").cast("string"), F.col("f").cast("string"), "g.x", "g.y", "h").collect()
    assert [tuple(r) for r in got] == [
        (7, 8, 1.5, 9.0, "1.2500", "2024-01-02 00:00:00", 3, None, [1, 2]),
        (70000, 8000000000, 2.5, 9.5, "12345.6789", "2024-01-02 03:04:05", 3000000000, "z", [3000000000])]


def test_narrower_and_missing_columns_change_nothing(spark, lake):
    lake.write(spark.createDataFrame([(1, "a")], "id long, s string"))
    lake.discover()
    lake.write(spark.createDataFrame([(2,)], "id int"))
    assert lake.discover() == {"t": ("updated", None)}
    assert lake.rows() == [(1, "a"), (2, None)]


def test_types_that_do_not_fit_are_refused(spark, lake):
    lake.write(spark.createDataFrame([(1,)], "id int"))
    lake.discover()
    lake.write(spark.createDataFrame([("x",)], "id string"))
    assert lake.discover() == {"t": ("refused", "id: int and string")}
    assert spark.table(f"{lake.name}.t").schema["id"].dataType == T.IntegerType()


def test_new_table_with_files_of_several_types(spark, lake):
    for dtype in ("int", "bigint", "smallint", "int"):
        lake.write(spark.createDataFrame([(1,)], f"id {dtype}"))
    lake.write(spark.createDataFrame([(1,)], "id int"), "u")
    lake.write(spark.createDataFrame([("x",)], "id string"), "u")
    assert lake.discover() == {"t": ("created", None), "u": ("refused", "id: int and string")}
    assert lake.rows() == [(1,)] * 4


def test_mixed_layouts_are_refused(spark, lake):
    lake.write(spark.createDataFrame([(1, "01")], "id long, month string"), by="month")
    lake.write(spark.createDataFrame([(2,)], "id long"))
    action, detail = lake.discover()["t"]
    assert action == "refused" and "month" in detail


def test_known_table_with_another_layout_is_refused(spark, lake):
    lake.write(spark.createDataFrame([(1,)], "id long"))
    lake.discover()
    spark.sql(f"DROP TABLE {lake.name}.t")
    catalog.register_parquet_table(spark, lake.name, "t", f"{lake.root}/t", [("id", "bigint")], ["day"], repair=False)
    assert lake.discover()["t"][0] == "refused"


def test_gone_folder_is_dropped_and_session_views_are_no_tables(spark, lake, tmp_path):
    lake.write(spark.range(2).toDF("id"))
    with sql.named(spark.range(3).toDF("id")) as view:
        lake.discover()
        assert [r["table"] for r in catalog.list_tables(spark, lake.name).collect()] == ["t"]
        assert [r["table"] for r in catalog.tables_detail(spark, lake.name).collect()] == ["t"]
        kept = spark.sql(f"SELECT count(*) AS n FROM {view}")
    assert kept.first()["n"] == 3 and not spark.catalog.tableExists(view)
    (tmp_path / "lake" / "t").rename(tmp_path / "elsewhere")
    assert lake.discover() == {"t": ("dropped", None)}


def test_since_reads_only_newer_footers(spark, lake):
    lake.write(spark.createDataFrame([(1,)], "id int"))
    lake.discover()
    lake.write(spark.createDataFrame([(1, 2)], "id int, x int"))
    assert lake.discover(since="2100-01-01T00:00:00") == {"t": ("updated", None)}
    assert lake.discover(since="2000-01-01T00:00:00") == {"t": ("altered", "added x")}
