"""Profiling and exploration queries.

Profiles run on the given tables and on two derived frames with real nulls:
``customer_activity`` (customers left-joined to their order totals, so
customers without orders have NULL totals; plus an all-NULL ``note``) and
``documents_labelled`` (documents left-joined to their labels).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.operators import explore as E
from basalt.operators import profile as P
from basalt.plans import views as V
from basalt.plans.registry import register


def customer_activity(spark, sf_dir):
    c = V.table(spark, sf_dir, "customer")
    o = (V.table(spark, sf_dir, "orders").groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_spent"),
              F.max("o_orderdate").alias("last_order")))
    return (c.join(o, c.c_custkey == o.o_custkey, "left")
            .select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "n_orders", "total_spent",
                    F.date_format("last_order", "yyyy-MM-dd").alias("last_order_text"),
                    F.lit(None).cast("string").alias("note")))


CA_SQL = """
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, o.n_orders, o.total_spent,
       strftime(o.last_order, '%Y-%m-%d') AS last_order_text, CAST(NULL AS VARCHAR) AS note
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_spent,
                                  max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey
"""
CA_COLUMNS = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
              ("c_mktsegment", "string"), ("n_orders", "bigint"), ("total_spent", "double"),
              ("last_order_text", "string"), ("note", "string")]
CA_NUMERIC = [c for c, t in CA_COLUMNS if t in ("bigint", "int", "double")]
CA_TEXT = [c for c, t in CA_COLUMNS if t == "string"]


def documents_labelled(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents")
    lab = V.table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


DL_SQL = """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
DL_COLUMNS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
              ("quality", "int"), ("toxic", "int")]


def _summary_sql(columns, base: str) -> str:
    parts = []
    for i, (c, t) in enumerate(columns):
        parts.append(f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null,
  count(*) - count({c}) AS nulls,
  coalesce(round((count(*) - count({c})) * 100.0::DOUBLE / nullif(count(*), 0), 2), 0.0::DOUBLE) AS null_pct,
  count(DISTINCT {c}) AS "distinct",
  coalesce(round(count(DISTINCT {c}) * 100.0::DOUBLE / nullif(count(*), 0), 2), 0.0::DOUBLE) AS distinct_pct,
  {i} AS position FROM {base}""")
    return "\nUNION ALL\n".join(parts)


@register("profile_column_summary", oracle=V.with_views(_summary_sql(CA_COLUMNS, "ca"), ca=CA_SQL))
def profile_column_summary(spark, sf_dir):
    """Per-column types, null and distinct counts and shares."""
    return P.column_summary(customer_activity(spark, sf_dir))


@register("profile_column_summary_documents", oracle=V.with_views(_summary_sql(DL_COLUMNS, "dl"), dl=DL_SQL))
def profile_column_summary_documents(spark, sf_dir):
    """P7 on documents with their (partial) labels."""
    return P.column_summary(documents_labelled(spark, sf_dir))


def _numeric_sql(cols, base):
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", min({c}::DOUBLE) AS min, max({c}::DOUBLE) AS max,
  round(avg({c}::DOUBLE), 2) AS mean, quantile_cont({c}::DOUBLE, 0.5) AS median,
  round(stddev_samp({c}::DOUBLE), 2) AS std FROM {base}""" for c in cols)


LI_COLUMNS = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
              ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
              ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "date")]


@register("profile_numeric_stats", oracle=V.with_views(_numeric_sql(CA_NUMERIC, "ca"), ca=CA_SQL))
def profile_numeric_stats(spark, sf_dir):
    """Min, max, mean, median, std per numeric column."""
    return P.numeric_stats(customer_activity(spark, sf_dir))


LI_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax"]


@register("profile_describe", oracle="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}::DOUBLE), 4) AS mean,
  round(stddev_samp({c}::DOUBLE), 4) AS std, min({c}::DOUBLE) AS min,
  quantile_cont({c}::DOUBLE, 0.25) AS p25, quantile_cont({c}::DOUBLE, 0.5) AS p50,
  quantile_cont({c}::DOUBLE, 0.75) AS p75, max({c}::DOUBLE) AS max FROM lineitem""" for c in LI_NUMERIC))
def profile_describe(spark, sf_dir):
    """describe() of every numeric lineitem column (exact quartiles)."""
    return P.describe(V.table(spark, sf_dir, "lineitem"))


@register("profile_top_values", oracle=V.with_views("""
SELECT "column", value, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT "column", value, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank
  FROM (""" + "\n  UNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM ca
      WHERE {c} IS NOT NULL GROUP BY 2""" for c in CA_TEXT) + """)
) WHERE rank <= 5""", ca=CA_SQL))
def profile_top_values(spark, sf_dir):
    """Five most frequent values per text column."""
    return P.top_values(customer_activity(spark, sf_dir), 5)


@register("profile_text_length", oracle="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", round(avg(length({c})), 1) AS avg_length FROM documents"""
    for c in ["text", "lang", "source"]))
def profile_text_length(spark, sf_dir):
    """P10: mean length of every text column of documents (whole texts)."""
    return P.mean_text_length(V.table(spark, sf_dir, "documents"))


@register("profile_duplicates", oracle="""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows,
       coalesce(round(sum(n - 1) * 100.0::DOUBLE / nullif(sum(n), 0), 2), 0.0::DOUBLE) AS duplicate_pct
FROM (SELECT count(*) AS n FROM lineitem GROUP BY ALL)""".replace("GROUP BY ALL", "GROUP BY " + ", ".join(c for c, _ in LI_COLUMNS)))
def profile_duplicates(spark, sf_dir):
    """Duplicate rows of lineitem, over all columns."""
    return P.duplicates(V.table(spark, sf_dir, "lineitem"))


@register("profile_empty_columns", oracle=V.with_views("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column" FROM ca HAVING count({c}) = 0 AND count(*) > 0""" for c, _ in CA_COLUMNS),
    ca=CA_SQL))
def profile_empty_columns(spark, sf_dir):
    """Columns without any value."""
    return P.empty_columns(customer_activity(spark, sf_dir))


@register("profile_high_cardinality", oracle=V.with_views("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column" FROM ca
        HAVING count(DISTINCT {c}) / count(*) > 0.95 AND count(*) > 100""" for c, _ in CA_COLUMNS), ca=CA_SQL))
def profile_high_cardinality(spark, sf_dir):
    """Columns with distinct / rows > 0.95 (more than 100 rows)."""
    df = customer_activity(spark, sf_dir)
    return P.high_cardinality(df)


def _null_share_sql(columns, base):
    nulls = " + ".join(f"(count(*) - count({c}))" for c, _ in columns)
    n = len(columns)
    return f"""SELECT CAST({nulls} AS BIGINT) AS null_cells, CAST(count(*) * {n} AS BIGINT) AS cells,
       coalesce(({nulls}) * 100.0::DOUBLE / nullif(count(*) * {n}, 0), 0.0::DOUBLE) AS null_pct FROM {base}"""


@register("profile_null_share", oracle=V.with_views(_null_share_sql(CA_COLUMNS, "ca"), ca=CA_SQL))
def profile_null_share(spark, sf_dir):
    """Share of null cells."""
    return P.null_share(customer_activity(spark, sf_dir))


def _quality_sql(columns, base, key_cols):
    n = len(columns)
    nulls = " + ".join(f"(count(*) - count({c}))" for c, _ in columns)
    empty = " + ".join(f"CASE WHEN count({c}) = 0 AND count(*) > 0 THEN 1 ELSE 0 END" for c, _ in columns)
    high = " + ".join(f"CASE WHEN count(DISTINCT {c}) / count(*) > 0.95 AND count(*) > 100 THEN 1 ELSE 0 END"
                      for c, _ in columns)
    allc = ", ".join(c for c, _ in columns)
    return f"""WITH dup AS (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows,
       coalesce(round(sum(n - 1) * 100.0::DOUBLE / nullif(sum(n), 0), 2), 0.0::DOUBLE) AS duplicate_pct
       FROM (SELECT count(*) AS n FROM {base} GROUP BY {allc})),
  st AS (SELECT {empty} AS empty_columns, {high} AS high_cardinality_columns,
       coalesce(({nulls}) * 100.0::DOUBLE / nullif(count(*) * {n}, 0), 0.0::DOUBLE) AS null_pct FROM {base})
SELECT duplicate_rows, duplicate_pct, CAST(empty_columns AS BIGINT) AS empty_columns,
       CAST(high_cardinality_columns AS BIGINT) AS high_cardinality_columns, round(null_pct, 4) AS null_pct,
       CAST((duplicate_rows > 0)::INTEGER + (empty_columns > 0)::INTEGER + (high_cardinality_columns > 0)::INTEGER
            AS INTEGER) AS total_issues,
       greatest(0.0::DOUBLE, round(100.0::DOUBLE - CASE WHEN duplicate_rows > 0 THEN least(duplicate_pct, 20.0::DOUBLE)
            ELSE 0.0::DOUBLE END - empty_columns * 5 - high_cardinality_columns * 2
            - least(null_pct, 30.0::DOUBLE), 1)) AS score
FROM dup, st"""


@register("profile_quality_score", oracle=V.with_views(_quality_sql(CA_COLUMNS, "ca", ["c_custkey"]), ca=CA_SQL))
def profile_quality_score(spark, sf_dir):
    """Quality score with its components."""
    return P.quality_score(customer_activity(spark, sf_dir))


@register("profile_quality_score_lineitem", oracle=_quality_sql(LI_COLUMNS, "lineitem", []))
def profile_quality_score_lineitem(spark, sf_dir):
    """P14 on the whole of lineitem."""
    return P.quality_score(V.table(spark, sf_dir, "lineitem"))


DATE_LIKE_SQL = """
SELECT "column", round(share, 4) AS parsed_share FROM (
  SELECT "column", avg(CASE WHEN try_cast(value AS TIMESTAMP) IS NOT NULL THEN 1.0 ELSE 0.0 END) AS share
  FROM (""" + "\n UNION ALL\n".join(
    f"""SELECT '{c}' AS "column", {c} AS value FROM ca WHERE {c} IS NOT NULL""" for c in CA_TEXT) + """)
  GROUP BY "column") WHERE share > 0.8"""


@register("profile_date_like", oracle=V.with_views(DATE_LIKE_SQL, ca=CA_SQL))
def profile_date_like(spark, sf_dir):
    """Text columns whose values parse as dates."""
    return P.date_like(customer_activity(spark, sf_dir))


CATEGORICAL_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "distinct",
        round(count(DISTINCT {c}) / count(*), 4) AS ratio FROM ca
        HAVING count(DISTINCT {c}) / count(*) < 0.05 AND count(DISTINCT {c}) > 1""" for c, _ in CA_COLUMNS)


@register("profile_categorical", oracle=V.with_views(CATEGORICAL_SQL, ca=CA_SQL))
def profile_categorical(spark, sf_dir):
    """Low-cardinality columns."""
    df = customer_activity(spark, sf_dir)
    return P.categorical(df)


def _id_sql(columns, base, legacy=False):
    out = []
    for c, _ in columns:
        name_rule = f"(lower('{c}') IN ('id', 'uuid', 'key') OR contains(lower('{c}'), 'id'))"
        unique = f"count(DISTINCT {c}) = count(*) AND count(*) > 10"
        cond = (f"(({unique}) AND lower('{c}') IN ('id', 'uuid', 'key')) OR contains(lower('{c}'), 'id')" if legacy
                else f"({unique}) AND {name_rule}")
        out.append(f"""SELECT '{c}' AS "column" FROM {base} HAVING {cond}""")
    return "\nUNION ALL\n".join(out)


@register("profile_id_columns", oracle=V.with_views(_id_sql(DL_COLUMNS, "dl"), dl=DL_SQL))
def profile_id_columns(spark, sf_dir):
    """Id columns (unique, > 10 rows, id-like name)."""
    df = documents_labelled(spark, sf_dir)
    return P.id_columns(df)


CONV_COLUMNS = [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")]


@register("profile_id_columns_legacy", oracle=_id_sql(CONV_COLUMNS, "conversations", legacy=True))
def profile_id_columns_legacy(spark, sf_dir):
    """P18 with the reference's precedence (D9): any name containing 'id'."""
    df = V.table(spark, sf_dir, "conversations")
    return P.id_columns(df, legacy_id_rule=True)


@register("profile_basic_info", oracle="""
SELECT CAST(column_index - 1 AS INTEGER) AS position, column_name AS "column",
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                      WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS dtype,
       (SELECT count(*) FROM customer) AS rows, 5 AS columns
FROM (SELECT column_name, column_type, row_number() OVER () AS column_index
      FROM (DESCRIBE customer))""")
def profile_basic_info(spark, sf_dir):
    """Shape, names and types."""
    return P.basic_info(V.table(spark, sf_dir, "customer"))


@register("profile_data_size", oracle="""
SELECT count(*) AS rows,
       CAST(sum(8 + 8 + strlen(o_orderstatus) + 8 + 8 + strlen(o_orderpriority)) AS BIGINT) AS bytes,
       round(sum(8 + 8 + strlen(o_orderstatus) + 8 + 8 + strlen(o_orderpriority)) / 1048576.0, 2) AS mb
FROM orders""")
def profile_data_size(spark, sf_dir):
    """Stored bytes of orders."""
    return P.data_size(V.table(spark, sf_dir, "orders"))


@register("profile_head", oracle="SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 10")
def profile_head(spark, sf_dir):
    """P3."""
    return P.head(V.table(spark, sf_dir, "lineitem"), 10, ["l_orderkey", "l_linenumber"])


@register("profile_tail", oracle="SELECT * FROM lineitem ORDER BY l_orderkey DESC, l_linenumber DESC LIMIT 10")
def profile_tail(spark, sf_dir):
    """P4."""
    return P.tail(V.table(spark, sf_dir, "lineitem"), 10, ["l_orderkey", "l_linenumber"])


@register("profile_sample", oracle="""
SELECT * FROM part ORDER BY md5('7/' || CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 10""")
def profile_sample(spark, sf_dir):
    """P5: 10 random parts, by the MD5 of seed and key."""
    return P.sample_rows(V.table(spark, sf_dir, "part"), 10, ["p_partkey"], seed=7)


def _report_sql():
    """P19 in SQL: the sections of the report from the per-operator oracle texts."""
    q = _quality_sql(CA_COLUMNS, "ca", ["c_custkey"])
    quality = "\nUNION ALL\n".join(
        f"SELECT 'quality' AS section, '{k}' AS name, CAST({k} AS VARCHAR) AS value FROM q"
        for k in ("score", "total_issues", "duplicate_rows", "empty_columns", "high_cardinality_columns"))
    date_like = DATE_LIKE_SQL
    categorical = CATEGORICAL_SQL
    ids = _id_sql(CA_COLUMNS, "ca")
    columns = "\nUNION ALL\n".join(
        f"SELECT 'column', concat(\"column\", '.{k}'), CAST(\"{k}\" AS VARCHAR) FROM sm"
        for k in ("dtype", "non_null", "nulls", "distinct"))
    return V.with_views(f"""{quality}
UNION ALL SELECT 'basic', 'rows', CAST(count(*) AS VARCHAR) FROM ca
UNION ALL SELECT 'basic', 'columns', '{len(CA_COLUMNS)}'
UNION ALL {columns}
UNION ALL SELECT 'date_column', "column", CAST(parsed_share AS VARCHAR) FROM ({date_like})
UNION ALL SELECT 'categorical_column', "column", CAST("distinct" AS VARCHAR) FROM ({categorical})
UNION ALL SELECT 'id_column', "column", CAST(NULL AS VARCHAR) FROM ({ids})""", ca=CA_SQL, q=q, sm=_summary_sql(CA_COLUMNS, "ca"))


@register("profile_report", oracle=_report_sql())
def profile_report(spark, sf_dir):
    """Full analysis of customer_activity as (section, name, value) rows."""
    return P.report(customer_activity(spark, sf_dir))


# ---- exploration ------------------------------------------------------------------

@register("explore_histogram", oracle="""
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
     h AS (SELECT CASE WHEN hi = lo THEN 1
                       ELSE least(CAST(floor(30 * (l_extendedprice - lo) / (hi - lo)) AS BIGINT) + 1, 30) END AS bin,
                  count(*) AS count
           FROM lineitem, b GROUP BY 1)
SELECT CAST(bin AS INTEGER) AS bin, lo + (bin - 1) * ((hi - lo) / 30.0::DOUBLE) AS lower,
       CASE WHEN hi = lo THEN hi ELSE lo + bin * ((hi - lo) / 30.0::DOUBLE) END AS upper, count
FROM h, b""")
def explore_histogram(spark, sf_dir):
    """P20: 30-bin histogram of l_extendedprice."""
    return E.histogram(V.table(spark, sf_dir, "lineitem"), "l_extendedprice", 30)


@register("explore_box_stats", oracle="""
WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.5) AS med,
                  quantile_cont(n_chars, 0.75) AS q3 FROM documents),
     f AS (SELECT q1, med, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT 'n_chars' AS "column", q1, med AS median, q3, iqr, lf AS lower_fence, uf AS upper_fence,
       min(n_chars::DOUBLE) FILTER (WHERE n_chars BETWEEN lf AND uf) AS lower_whisker,
       max(n_chars::DOUBLE) FILTER (WHERE n_chars BETWEEN lf AND uf) AS upper_whisker,
       count(*) FILTER (WHERE NOT (n_chars BETWEEN lf AND uf)) AS outliers
FROM documents, f GROUP BY q1, med, q3, iqr, lf, uf""")
def explore_box_stats(spark, sf_dir):
    """Box-plot numbers of n_chars."""
    return E.box_stats(V.table(spark, sf_dir, "documents"), "n_chars")


@register("explore_box_outliers", oracle="""
WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM documents)
SELECT documents.* FROM documents, q
WHERE n_chars < q1 - 1.5 * (q3 - q1) OR n_chars > q3 + 1.5 * (q3 - q1)""")
def explore_box_outliers(spark, sf_dir):
    """Rows outside the fences of n_chars."""
    return E.box_outliers(V.table(spark, sf_dir, "documents"), "n_chars")


CORR_COLS = LI_NUMERIC


@register("explore_correlation", oracle="\nUNION ALL\n".join(
    [f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 10) AS corr FROM lineitem"""
     for a in CORR_COLS for b in CORR_COLS]))
def explore_correlation(spark, sf_dir):
    """Correlation matrix of all numeric lineitem columns."""
    m = E.correlation_matrix(V.table(spark, sf_dir, "lineitem"), CORR_COLS)
    return m.withColumn("corr", F.round("corr", 10))


@register("explore_value_counts", oracle="""
SELECT l_partkey AS value, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, value LIMIT 15""")
def explore_value_counts(spark, sf_dir):
    """15 most frequent part keys."""
    return E.value_counts(V.table(spark, sf_dir, "lineitem"), "l_partkey", 15)


@register("explore_distinct_values", oracle="""
SELECT value, (SELECT count(DISTINCT p_name) FROM part) > 50 AS more_values
FROM (SELECT DISTINCT p_name AS value FROM part WHERE p_name IS NOT NULL ORDER BY value LIMIT 50)""")
def explore_distinct_values(spark, sf_dir):
    """Up to 50 distinct part names (more exist)."""
    return E.distinct_values(V.table(spark, sf_dir, "part"), "p_name", 50)


@register("explore_value_filter", oracle="SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def explore_value_filter(spark, sf_dir):
    """P25 with a value list."""
    return E.filter_values(V.table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@register("explore_value_filter_semi", oracle="""
SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def explore_value_filter_semi(spark, sf_dir):
    """P25 with the value set given as a DataFrame (left semi join)."""
    keys = V.table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 1).select("n_nationkey")
    return E.filter_values(V.table(spark, sf_dir, "customer"), "c_nationkey", keys)


@register("explore_search", oracle="""
SELECT * FROM part WHERE regexp_matches(p_name, 'RED', 'i') OR regexp_matches(p_brand, 'RED', 'i')
   OR regexp_matches(p_type, 'RED', 'i')""")
def explore_search(spark, sf_dir):
    """Case-insensitive search over all text columns."""
    return E.search(V.table(spark, sf_dir, "part"), "RED")


@register("explore_search_no_hit", oracle="SELECT * FROM part WHERE regexp_matches(p_name, 'zzqx', 'i')")
def explore_search_no_hit(spark, sf_dir):
    """No match gives no rows."""
    return E.search(V.table(spark, sf_dir, "part"), "zzqx")


@register("explore_page", oracle="""
WITH f AS (SELECT * FROM orders WHERE o_orderstatus IN ('F')
             AND (regexp_matches(o_orderstatus, 'urgent', 'i') OR regexp_matches(o_orderpriority, 'urgent', 'i')))
SELECT *, row_number() OVER (ORDER BY o_orderkey) + 20 AS row_no,
       (SELECT count(*) FROM f) AS total_rows, CAST(ceil((SELECT count(*) FROM f) / 20.0) AS BIGINT) AS total_pages
FROM (SELECT * FROM f ORDER BY o_orderkey LIMIT 20 OFFSET 20)""")
def explore_page(spark, sf_dir):
    """Value filter AND search, page 2 of 20 rows."""
    return E.explore(V.table(spark, sf_dir, "orders"), {"o_orderstatus": ["F"]}, "urgent", 2, 20,
                     [F.asc("o_orderkey")])


@register("explore_numeric_columns", oracle="SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def explore_numeric_columns(spark, sf_dir):
    """Numeric columns only."""
    return P.columns_of_type(V.table(spark, sf_dir, "orders"), "numeric")
