"""Catalog queries (C1-C10): tables written from the given data, registered,
discovered and described.  Table lists and schemas are checked against the
oracle's own view of the tables (DuckDB ``DESCRIBE``) through the C6 type map."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from basalt.operators import catalog as C
from basalt.plans import views as V
from basalt.plans.registry import register
from basalt.session import scratch_dir


def _lake(spark, sf_dir):
    """A small lake: events as a date-partitioned table, orders as a plain one."""
    root = scratch_dir(spark, "catalog")
    ev = V.table(spark, sf_dir, "events")
    (ev.select("*", F.date_format("ts", "yyyy").alias("year"), F.date_format("ts", "MM").alias("month"),
               F.date_format("ts", "dd").alias("day"))
     .write.partitionBy("year", "month", "day").parquet(f"{root}/events"))
    V.table(spark, sf_dir, "orders").write.parquet(f"{root}/orders")
    return root


@register("catalog_auto_register", oracle="""
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, count(*) AS rows FROM events GROUP BY 1, 2""")
def catalog_auto_register(spark, sf_dir):
    """Register a table from one of its files (schema from the footer,
    location and partitions from the path), repair partitions, query it."""
    root = _lake(spark, sf_dir)
    sample = (spark.read.parquet(f"{root}/events").select(F.input_file_name().alias("f")).limit(1).first()["f"])
    db = "cat_" + uuid.uuid4().hex[:8]
    C.create_database(spark, db, f"{root}/_db")
    C.auto_register(spark, db, "events", sample)
    return spark.sql(f"SELECT year, month, count(*) AS rows FROM {db}.events GROUP BY year, month")


@register("catalog_registered_rows", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS day,
       CAST(l_extendedprice AS DECIMAL(12, 2)) AS price, l_returnflag AS flag FROM lineitem""")
def catalog_registered_rows(spark, sf_dir):
    """A table with date, decimal and struct columns, registered from one file and read back by value."""
    root = scratch_dir(spark, "registered")
    (V.table(spark, sf_dir, "lineitem")
     .select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("day"),
             F.col("l_extendedprice").cast("decimal(12,2)").alias("price"), F.struct(F.col("l_returnflag").alias("flag")).alias("s"))
     .write.parquet(f"{root}/items"))
    db = "reg_" + uuid.uuid4().hex[:8]
    C.create_database(spark, db, f"{root}/_db")
    C.auto_register(spark, db, "items", spark.read.parquet(f"{root}/items").inputFiles()[0])
    return spark.sql(f"SELECT l_orderkey, l_linenumber, l_quantity, day, price, s.flag AS flag FROM {db}.items")


@register("catalog_two_roots", oracle="""
SELECT 'customer' AS "table" UNION ALL SELECT 'events' UNION ALL SELECT 'orders'""")
def catalog_two_roots(spark, sf_dir):
    """Discovering a second root leaves the tables of the first alone; the list of all tables."""
    first, second = _lake(spark, sf_dir), scratch_dir(spark, "catalog2")
    V.table(spark, sf_dir, "customer").write.parquet(f"{second}/customer")
    db = "two_" + uuid.uuid4().hex[:8]
    C.create_database(spark, db, f"{second}/_db")
    C.discover_tables(spark, db, first)
    C.discover_tables(spark, db, second)
    return C.list_tables(spark, db)


@register("catalog_partition_keys", oracle="""
SELECT key, 'year,month' AS partition_keys
FROM (SELECT concat('lake/events/year=', strftime(ts, '%Y'), '/month=', strftime(ts, '%m'), '/part-',
                    CAST(event_id AS VARCHAR), '.parquet') AS key FROM events)""")
def catalog_partition_keys(spark, sf_dir):
    """C5 over many keys: partition names of each file key, as a column expression."""
    ev = V.table(spark, sf_dir, "events")
    keys = ev.select(F.concat(F.lit("lake/events/year="), F.date_format("ts", "yyyy"), F.lit("/month="),
                              F.date_format("ts", "MM"), F.lit("/part-"), F.col("event_id").cast("string"),
                              F.lit(".parquet")).alias("key"))
    return keys.select("key", F.array_join(C.partition_keys_col("key"), ",").alias("partition_keys"))


@register("catalog_type_map", oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def catalog_type_map(spark, sf_dir):
    """Every column cast to its lake type (bigint, double, boolean, timestamp, string)."""
    out = C.conform(V.table(spark, sf_dir, "orders"))
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@register("catalog_discover", oracle="""
SELECT 'events' AS "table", 'created' AS action, CAST((SELECT count(*) FROM (DESCRIBE events)) + 3 AS INTEGER) AS columns
UNION ALL
SELECT 'orders', 'created', CAST((SELECT count(*) FROM (DESCRIBE orders)) AS INTEGER)""")
def catalog_discover(spark, sf_dir):
    """C10 + C7/C8: crawl the lake root; tables created, listed with column counts."""
    root = _lake(spark, sf_dir)
    db = "disc_" + uuid.uuid4().hex[:8]
    actions = C.discover_tables(spark, db, root)
    detail = C.tables_detail(spark, db)
    return actions.join(detail, "table").select("table", "action", "columns")


@register("catalog_rediscover_changed", oracle="""
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_totalprice,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def catalog_rediscover_changed(spark, sf_dir):
    """The files of a known table gain a column and a wider type; the table follows and is read by value."""
    root = scratch_dir(spark, "changed")
    orders = V.table(spark, sf_dir, "orders")
    old = orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_custkey").cast("int"), "o_totalprice")
    new = orders.where("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_custkey").cast("long"), "o_totalprice", "o_orderpriority")
    db = "chg_" + uuid.uuid4().hex[:8]
    C.create_database(spark, db, f"{root}/_db")
    old.write.parquet(f"{root}/lake/orders")
    C.discover_tables(spark, db, f"{root}/lake")
    new.write.mode("append").parquet(f"{root}/lake/orders")
    (change,) = C.discover_tables(spark, db, f"{root}/lake").collect()
    if change["action"] != "altered":
        raise RuntimeError(f"the table does not follow its files: {change}")
    return spark.table(f"{db}.orders")


# C6 on DuckDB's own column types of ``events``, then the three partition keys.
LAKE_SCHEMA_SQL = """
SELECT column_name AS "column",
       CASE WHEN column_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT', 'UTINYINT', 'USMALLINT',
                                 'UINTEGER', 'UBIGINT') THEN 'bigint'
            WHEN column_type IN ('FLOAT', 'DOUBLE') THEN 'double'
            WHEN column_type = 'BOOLEAN' THEN 'boolean'
            WHEN column_type LIKE 'TIMESTAMP%' THEN 'timestamp'
            ELSE 'string' END AS type,
       false AS is_partition
FROM (DESCRIBE events)
UNION ALL
SELECT * FROM (VALUES ('year', 'string', true), ('month', 'string', true), ('day', 'string', true))
    p("column", type, is_partition)"""


@register("catalog_table_schema", oracle=LAKE_SCHEMA_SQL)
def catalog_table_schema(spark, sf_dir):
    """Schema of a discovered table (column, lake type, partition flag)."""
    root = _lake(spark, sf_dir)
    db = "schema_" + uuid.uuid4().hex[:8]
    C.discover_tables(spark, db, root)
    return C.table_schema(spark, db, "events")


@register("catalog_locations", oracle="""
SELECT key, regexp_replace(regexp_replace(key, '[^/]*$', ''), '/[^/=]+=.*$', '/') AS location
FROM (SELECT concat('lake/events/year=', strftime(ts, '%Y'), '/month=', strftime(ts, '%m'), '/part-',
                    CAST(event_id AS VARCHAR), '.parquet') AS key FROM events)""")
def catalog_locations(spark, sf_dir):
    """C4/C5 over many keys: table location of each file key, as a column expression."""
    ev = V.table(spark, sf_dir, "events")
    keys = ev.select(F.concat(F.lit("lake/events/year="), F.date_format("ts", "yyyy"), F.lit("/month="),
                              F.date_format("ts", "MM"), F.lit("/part-"), F.col("event_id").cast("string"),
                              F.lit(".parquet")).alias("key"))
    return keys.select("key", C.table_location_col("key").alias("location"))
