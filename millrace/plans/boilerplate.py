"""Queries on what all postings of a platform or of a company say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.boilerplate import mark_repeated, marked_lines
from millrace.registry import query, table

#: Lines of a posting of each platform (one `{}` is the part's own text) with the step that drops each.
PAGES = {
    "workday": [("About us", "description"), ("Description", "description"), ("Build {}", None), ("About Samsung and more", "about"), ("Total Rewards", "equal"), ("Pay and more", "equal"), ("What We Offer", "equal")],
    "icims": [("WHAT YOU DO AT AMD CHANGES EVERYTHING now", "opening"), ("Build {}", None), ("Benefits offered", "closing"), ("Build {} again", "closing")],
    "successfactors": [("About TSMC", "opening"), ("At Lam Research", None), ("Build {}", None), ("Our Perks and Benefits", None), ("Please be informed that TSMC", "closing"), ("x", "closing")],
    "oracle": [("Change the world. Love your job.", "phrases"), ("Why TI", "paragraphs"), ("Build {}", None), ("Why TI matters", None)],
    "other": [("Why TI", None), ("Build {}", None)],
}
PAGES["workday"] = [("Old news", "opening"), ("They care for you at work, at home, or wherever you may go.", "opening"), ("Learn", "description"), *PAGES["workday"][1:4], ("An equal opportunity employer", "equal"), ("Build {}", "equal")]


def _sql_rows() -> str:
    text = lambda t: "'" + t.replace("'", "''").replace("{}", "' || p_name || '") + "'"
    by = lambda b: f"'{b}'" if b else "CAST(NULL AS VARCHAR)"
    return " UNION ALL ".join(f"SELECT p_partkey, {i} AS place, {text(t)} AS text, {by(b)} AS by_step FROM part WHERE p_partkey % {len(PAGES)} = {k}" for k, page in enumerate(PAGES.values()) for i, (t, b) in enumerate(page))


@query(_sql_rows())
def boilerplate_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every line of postings of all platforms, with the step that drops it."""
    k = F.col("p_partkey")
    page = lambda lines: F.array(*[F.replace(F.lit(t), F.lit("{}"), F.col("p_name")) for t, _ in lines])
    lines, platform = F.array().cast("array<string>"), F.lit(None).cast("string")
    for i, (name, page_lines) in enumerate(PAGES.items()):
        lines, platform = F.when(k % len(PAGES) == i, page(page_lines)).otherwise(lines), F.when(k % len(PAGES) == i, name).otherwise(platform)
    rows = table(spark, d, "part").select("p_partkey", platform.alias("platform"), lines.alias("lines"))
    rows = rows.select("p_partkey", F.posexplode(marked_lines(F.col("platform"), F.col("lines"))).alias("place", "x"))
    return rows.select("p_partkey", "place", "x.text", F.col("x.by").alias("by_step"))


@query("""WITH own AS (SELECT o_orderkey, o_orderpriority AS company, unnest(['Customer ' || o_custkey, 'We are ' || o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN 'Some of ' || o_orderpriority ELSE 'Others' END, o_orderstatus]) AS text, unnest([0, 1, 2, 3]) AS place FROM orders),
counted AS (SELECT company, text, count(DISTINCT o_orderkey) AS n FROM own GROUP BY ALL), sizes AS (SELECT o_orderpriority AS company, count(*) AS postings FROM orders GROUP BY ALL)
SELECT o_orderkey, place, text, CASE WHEN n >= 20 AND n >= 0.4 * postings THEN 'repeated' END AS by_step FROM own JOIN counted USING (company, text) JOIN sizes USING (company)""")
def repeated_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Lines that stand in four tenths of the postings of a company."""
    k = F.col("o_orderkey")
    lines = F.array(F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")), F.concat(F.lit("We are "), "o_orderpriority"), F.when(k % 3 == 0, F.concat(F.lit("Some of "), "o_orderpriority")).otherwise("Others"), "o_orderstatus")
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("company"), marked_lines(F.lit("other"), lines).alias("lines"))
    found = mark_repeated(rows, "company", "lines", share=0.4)
    return found.select("o_orderkey", F.posexplode("lines").alias("place", "x")).select("o_orderkey", "place", "x.text", F.col("x.by").alias("by_step"))
