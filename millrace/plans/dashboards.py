"""Trend, ratio and table queries, and the education extract's relational steps.

Orders stand for enrollments and returned line items for completions; regions are sectors and order
priorities categories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import standardize_code
from millrace.operators.supply import dashboard_filter, distinct_with_null, enrich, fill_rates, in_years, only_codes, total, trend, union_by_name, with_snake_case
from millrace.registry import query, table


def _enrollment(spark: SparkSession, d: str, years: tuple[int, int] | None = None) -> DataFrame:
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("sector"))
    people = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "sector")
    orders = table(spark, d, "orders")
    if years:
        orders = orders.filter(in_years("o_orderdate", *years))
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(F.year("o_orderdate").alias("year"), "sector", F.col("o_orderpriority").alias("category"), F.col("o_totalprice").alias("count"))


@query("""
WITH e AS (SELECT year(o_orderdate) y, sum(CAST(o_totalprice AS DECIMAL(18,2))) v FROM orders WHERE year(o_orderdate) BETWEEN 1992 AND 1998 GROUP BY 1),
     c AS (SELECT year(l_shipdate) y, sum(CAST(l_extendedprice AS DECIMAL(18,2))) v FROM lineitem WHERE l_returnflag = 'R' AND year(l_shipdate) BETWEEN 1992 AND 1998 GROUP BY 1)
SELECT CAST(e.y AS INTEGER) AS academic_year, CAST(e.v AS DOUBLE) AS enrolled, CAST(c.v AS DOUBLE) AS completed,
       CAST(c.v AS DOUBLE) / nullif(CAST(e.v AS DOUBLE), 0) AS pipeline_rate
FROM e LEFT JOIN c ON e.y IS NOT DISTINCT FROM c.y
""")
def pipeline_rate(spark: SparkSession, d: str) -> DataFrame:
    """Two yearly sums, left-joined on the year, and their ratio (null for a zero or missing part)."""

    def yearly(df: DataFrame, day: str, amount: str, name: str) -> DataFrame:
        year = F.year(day)
        return trend(df.filter(in_years(day, 1992, 1998)).select(year.alias("academic_year"), amount), ["academic_year"], amount, name)

    e = yearly(table(spark, d, "orders"), "o_orderdate", "o_totalprice", "enrolled")
    c = yearly(table(spark, d, "lineitem").filter("l_returnflag = 'R'"), "l_shipdate", "l_extendedprice", "completed")
    return e.join(c, e.academic_year.eqNullSafe(c.academic_year), "left").select(e.academic_year, "enrolled", "completed", F.try_divide("completed", "enrolled").alias("pipeline_rate"))


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, r_name AS sector, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE year(o_orderdate) BETWEEN 1993 AND 1997 GROUP BY 1, 2""")
def enrollment_trend(spark: SparkSession, d: str) -> DataFrame:
    return trend(dashboard_filter(_enrollment(spark, d, (1993, 1997)), low=1993, high=1997), ["year", "sector"], "count", "total")


@query("""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, r_name AS sector, CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE l_returnflag = 'R' AND year(l_shipdate) BETWEEN 1993 AND 1997 GROUP BY 1, 2""")
def completions_trend(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", F.col("r_name").alias("sector"))
    rows = table(spark, d, "lineitem").filter((F.col("l_returnflag") == "R") & in_years("l_shipdate", 1993, 1997)).join(places, F.col("l_suppkey") == F.col("s_suppkey")).select(F.year("l_shipdate").alias("year"), "sector", "l_extendedprice")
    return trend(dashboard_filter(rows, low=1993, high=1997), ["year", "sector"], "l_extendedprice", "total")


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS price FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' AND o_orderpriority = '1-URGENT' AND year(o_orderdate) BETWEEN 1994 AND 1996""")
def dash_filter(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    orders = table(spark, d, "orders").filter(in_years("o_orderdate", 1994, 1996))
    rows = orders.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"), F.col("r_name").alias("sector"), F.col("o_orderpriority").alias("category"))
    return dashboard_filter(rows, "ASIA", "1-URGENT", 1994, 1996).select("o_orderkey", "year", "price")


@query("SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS low, CAST(max(year(o_orderdate)) AS INTEGER) AS high FROM orders")
def minmax(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").agg(F.min(F.year("o_orderdate")).alias("low"), F.max(F.year("o_orderdate")).alias("high"))


@query("SELECT DISTINCT c_mktsegment AS choice FROM customer WHERE c_mktsegment IS NOT NULL")
def distinct_sorted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_mktsegment").alias("choice")).filter("choice is not null").distinct().orderBy("choice")


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH' ORDER BY o_totalprice DESC, o_orderkey LIMIT 15 OFFSET 15")
def table_page(spark: SparkSession, d: str) -> DataFrame:
    """The second page of 15 rows; the limit is the feature."""
    return table(spark, d, "orders").filter("o_orderpriority = '2-HIGH'").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(15).limit(15).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("""WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN p_name ELSE lpad(CAST(p_partkey AS VARCHAR), 8, '0') || ' - ' || p_name END AS cip_desc FROM part),
s AS (SELECT *, trim(regexp_replace(cip_desc, ' *-.*$', '')) AS c FROM t),
k AS (SELECT p_partkey, CASE WHEN regexp_matches(c, '^[0-9]{8}$') THEN substr(c, 1, 2) || '.' || substr(c, 3, 4) END AS code FROM s)
SELECT p_partkey, code, substr(code, 1, 2) AS family FROM k""")
def standardize_codes(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    text = F.when(F.col("p_partkey") % 10 == 0, F.col("p_name")).otherwise(F.concat(F.lpad(F.col("p_partkey").cast("string"), 8, "0"), F.lit(" - "), "p_name"))
    code = standardize_code(text)
    return part.select("p_partkey", code.alias("code"), code.substr(1, 2).alias("family"))


#: Codes kept, with their labels (bounded by this list).
BRANDS = {"Brand#11": "Computing", "Brand#12": "Engineering", "Brand#21": "Technology", "Brand#22": "Science", "Brand#33": "Trades"}
_BRANDS_SQL = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in BRANDS.items()) + ") AS b(code, label)"


def _brands(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(BRANDS.items()), "p_brand string, label string"))


@query(f"SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT code FROM {_BRANDS_SQL})")
def semi_code_filter(spark: SparkSession, d: str) -> DataFrame:
    return only_codes(table(spark, d, "part").select("p_partkey", "p_brand"), _brands(spark).select("p_brand"), "p_brand")


@query(f"SELECT p_partkey, p_brand, label FROM part JOIN {_BRANDS_SQL} ON p_brand = code")
def dim_enrich(spark: SparkSession, d: str) -> DataFrame:
    return enrich(table(spark, d, "part").select("p_partkey", "p_brand"), _brands(spark), "p_brand")


@query(f"SELECT p_partkey, label FROM part LEFT JOIN {_BRANDS_SQL} ON p_brand = code")
def map_lookup(spark: SparkSession, d: str) -> DataFrame:
    labels = F.create_map(*[F.lit(x) for pair in BRANDS.items() for x in pair])
    return table(spark, d, "part").select("p_partkey", F.try_element_at(labels, F.col("p_brand")).alias("label"))


@query("""SELECT c_custkey AS key, c_name AS name, 'University' AS sector, 'Enrollment' AS metric, c_mktsegment AS segment, NULL::VARCHAR AS brand FROM customer
UNION ALL SELECT s_suppkey, s_name, 'Community College', 'Enrollment', NULL, NULL FROM supplier
UNION ALL SELECT p_partkey, p_name, 'Technical', 'Completions', NULL, p_brand FROM part""")
def union_sectors(spark: SparkSession, d: str) -> DataFrame:
    """Three tagged sources with different columns, united by name."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit("University").alias("sector"), F.lit("Enrollment").alias("metric"))
    s = table(spark, d, "supplier").select(F.lit("Community College").alias("sector"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit("Enrollment").alias("metric"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.lit("Technical").alias("sector"), F.lit("Completions").alias("metric"))
    return union_by_name(c, s, p)


@query("SELECT c_custkey AS customer_id, c_name AS customer_name, 'University' AS institution_sector, CAST(c_nationkey AS INTEGER) AS year_key FROM customer")
def tag_columns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").withColumnsRenamed({"c_custkey": "customer_id", "c_name": "customer_name"}).withColumns({"institution_sector": F.lit("University"), "year_key": F.col("c_nationkey").try_cast("int")}).select("customer_id", "customer_name", "institution_sector", "year_key")


@query('SELECT o_orderkey AS order_key, o_totalprice AS total_price, o_orderpriority AS order_priority FROM orders')
def scan_snake_case(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "orders").select(F.col("o_orderkey").alias("OrderKey"), F.col("o_totalprice").alias("TotalPrice"), F.col("o_orderpriority").alias("Order Priority"))
    return with_snake_case(raw)


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type FROM events) GROUP BY 1")
def count_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Null is a group of its own."""
    kind = F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type")
    return table(spark, d, "events").select(kind).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT CAST(count(DISTINCT k) + max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct FROM (SELECT CASE WHEN event_id % 7 <> 0 THEN user_id END AS k FROM events)")
def n_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("k")).agg(distinct_with_null("k").cast("long").alias("n_distinct"))


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type IS NOT NULL AND event_id % 7 <> 0 GROUP BY 1")
def freq_table(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").filter("event_type is not null and event_id % 7 <> 0").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type")


@query("""WITH t AS (SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority FROM orders),
c AS (SELECT count(*) AS n, count(status) AS a, count(priority) AS b FROM t)
SELECT 'status' AS field, CAST(a AS BIGINT) AS filled, a / n AS share FROM c UNION ALL SELECT 'priority', b, b / n FROM c""")
def fill_rate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("status"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("priority"))
    return fill_rates(rows, ["status", "priority"])


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (p_brand IS NULL) AS BIGINT) AS missing, count(*) = count(DISTINCT p_partkey) AS unique_key FROM part")
def assertions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").agg(F.count("*").alias("n_rows"), F.count_if(F.col("p_brand").isNull()).alias("missing"), (F.count("*") == F.countDistinct("p_partkey")).alias("unique_key"))


@query("SELECT o_orderpriority AS category, CAST(sum(CAST(CASE WHEN o_orderkey % 2 = 0 AND o_orderpriority <> '5-LOW' THEN o_totalprice END AS DECIMAL(18,2))) IS NULL AS BOOLEAN) AS none, CAST(coalesce(sum(CAST(CASE WHEN o_orderkey % 2 = 0 AND o_orderpriority <> '5-LOW' THEN o_totalprice END AS DECIMAL(18,2))), 0) AS DOUBLE) AS total FROM orders GROUP BY 1")
def sum_of_nulls(spark: SparkSession, d: str) -> DataFrame:
    """A group whose values are all null sums to 0."""
    value = F.when((F.col("o_orderkey") % 2 == 0) & (F.col("o_orderpriority") != "5-LOW"), F.col("o_totalprice"))
    return table(spark, d, "orders").select(F.col("o_orderpriority").alias("category"), value.alias("v")).groupBy("category").agg(F.sum("v").isNull().alias("none"), total(F.col("v")).alias("total"))


@query("SELECT r_regionkey, r_name FROM region")
def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "region").select("r_regionkey", "r_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0")
def active_dim_scan(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").withColumn("active", F.col("c_custkey") % 3 != 0).filter("active").select("c_custkey", "c_name")


@query("SELECT n_nationkey, n_name FROM nation WHERE NOT (n_nationkey % 5 = 0)")
def dim_leaf_filter(spark: SparkSession, d: str) -> DataFrame:
    """Options of a list without its group rows."""
    return table(spark, d, "nation").withColumn("is_group", F.col("n_nationkey") % 5 == 0).filter(~F.col("is_group")).select("n_nationkey", "n_name")
