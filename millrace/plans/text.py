"""Queries of the scalar text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import lines as L
from millrace.functions import scalars as S
from millrace.registry import query, table


@query("SELECT doc_id, trim(regexp_replace(text, '[\\s\\x0b\\x1c-\\x1f\\x85\\x{a0}]+', ' ', 'g')) AS clean FROM documents")
def squish(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", S.squish(F.col("text")).alias("clean"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[\\x01-\\x1F\\x7F]', ' ', 'g'), '[\\s\\x85\\x{a0}]+', ' ', 'g')) AS clean FROM documents")
def sanitize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", S.sanitize(F.col("text")).alias("clean"))


@query("WITH t AS (SELECT doc_id, trim(regexp_replace(text, '[\\s\\x0b\\x85\\x{a0}]+', ' ', 'g')) AS c FROM documents) SELECT doc_id, CASE WHEN length(c) >= 3 THEN substr(c, 1, 5000) END AS clean FROM t")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", S.clean_text(F.col("text")).alias("clean"))


@query("SELECT s_suppkey, trim(regexp_replace(lower(' -- ' || s_name || ', Inc.--'), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM supplier")
def slug(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", S.slug(F.concat(F.lit(" -- "), "s_name", F.lit(", Inc.--"))).alias("slug"))


@query("""SELECT o_orderkey, CAST(CASE o_orderkey % 9 WHEN 5 THEN DATE '1998-08-02' WHEN 6 THEN DATE '1998-08-01' WHEN 7 THEN DATE '1998-08-02' - CAST(o_orderkey % 40 AS INTEGER) WHEN 8 THEN DATE '1998-08-02' - CAST(7 * (o_orderkey % 9) AS INTEGER)
ELSE o_orderdate END AS DATE)::VARCHAR AS day FROM orders""")
def parse_date(spark: SparkSession, d: str) -> DataFrame:
    """Dates rendered in nine forms are parsed back."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    shown = F.when(k % 9 == 0, F.date_format(day, "yyyy-MM-dd")).when(k % 9 == 1, F.date_format(day, "M/d/yyyy")).when(k % 9 == 2, F.date_format(day, "MMMM d, yyyy")).when(k % 9 == 3, F.date_format(day, "MMM d, yyyy")).when(k % 9 == 4, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
    shown = F.coalesce(shown, F.when(k % 9 == 5, "Posted Today").when(k % 9 == 6, "Posted Yesterday").when(k % 9 == 7, F.concat(F.lit("Posted "), (k % 40).cast("string"), F.lit("+ Days Ago"))).otherwise("8 weeks ago"))
    return table(spark, d, "orders").select("o_orderkey", S.parse_date(shown, F.lit("1998-08-02").cast("date")).cast("string").alias("day"))


@query("SELECT o_orderkey, 'Q' || quarter(o_orderdate) || '_' || year(o_orderdate) AS label FROM orders")
def quarter_label(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", S.quarter_label(F.col("o_orderdate")).alias("label"))


@query("""SELECT page_id, nullif(regexp_extract(url, '^https?://([^./]+)\\.', 1), '') AS tenant, nullif(regexp_extract(url, '^(https?://[^/?#]+)', 1), '') AS base,
coalesce(nullif(regexp_extract(url, '^https?://[^/]+/(?:[a-z]{2}-[A-Z]{2}/)?([^/?#]+)', 1), ''), 'External') AS site, coalesce(nullif(regexp_extract(url, '/sites/([^/?#]+)', 1), ''), 'CX') AS number FROM pages""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", S.tenant_of(u).alias("tenant"), S.base_of(u).alias("base"), S.site_of(u).alias("site"), S.site_number_of(u).alias("number"))


@query("SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages")
def query_params(spark: SparkSession, d: str) -> DataFrame:
    q = S.query_params(F.col("url"))
    return table(spark, d, "pages").select("page_id", F.nullif(F.try_element_at(q, F.lit("page")), F.lit("")).alias("page"), F.nullif(F.try_element_at(q, F.lit("ref")), F.lit("")).alias("ref"))


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN 'https://jobs.example.com/job/' || page_id ELSE 'https://jobs.example.com/job/' || page_id END AS link FROM pages""")
def absolutize(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("page_id")
    href = F.when(k % 3 == 0, F.col("url")).when(k % 3 == 1, F.concat(F.lit("/job/"), k.cast("string"))).otherwise(F.concat(F.lit("job/"), k.cast("string")))
    return table(spark, d, "pages").select("page_id", S.absolutize(href, F.lit("https://jobs.example.com")).alias("link"))


@query("SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS plain FROM pages")
def strip_tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", S.strip_tags(F.col("html")).alias("plain"))


def _decoded_sql(column: str) -> str:
    for name, char in S.ENTITIES:
        column = f"replace({column}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    return column


@query(f"SELECT page_id, {_decoded_sql('html')} AS plain FROM pages")
def entity_decode(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", S.decode_entities(F.col("html")).alias("plain"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '$' || (1000 + p_size) || '-$' || (2000 + p_size) WHEN 1 THEN '$' || (1000 + p_size) || '+' WHEN 2 THEN '$' || (1000 + p_size) || '-$' || (3000 + p_size) WHEN 3 THEN '$' || (1000 + p_size) || ' to $' || (2000 + p_size) END AS pay FROM part""")
def salary_extract(spark: SparkSession, d: str) -> DataFrame:
    k, a, b = F.col("p_partkey"), (F.col("p_size") + 1000).cast("string"), (F.col("p_size") + 2000).cast("string")
    text = F.when(k % 5 == 0, F.concat(F.lit("Pay: $"), a, F.lit("-$"), b, F.lit(" a year"))).when(k % 5 == 1, F.concat(F.lit("from $"), a, F.lit("+ now"))).when(k % 5 == 2, F.concat(a, F.lit(" USD - "), (F.col("p_size") + 3000).cast("string"), F.lit(" USD"))).when(k % 5 == 3, F.concat(F.lit("$"), a, F.lit(" to $"), b)).otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", S.salary(text).alias("pay"))


@query("SELECT doc_id, CASE WHEN length(text) > 0 THEN CASE WHEN regexp_matches(text, '(?i)nicht') THEN 'No' WHEN regexp_matches(text, '(?i)ation') THEN 'Yes' END END AS flag FROM documents")
def keyword_flag(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", S.keyword_flag(F.col("text"), "(?i)ation", "(?i)nicht").alias("flag"))


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)(tionner|keitung|quele)')")
def keyword_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter(F.col("text").rlike("(?i)(tionner|keitung|quele)")).select("doc_id")


#: Places for the location filters.
PLACES = ["Austin, Texas", "Austin, TX", "US-TX", "Boise, Idaho, United States", "Tbilisi, Georgia", "Hsinchu, Taiwan", "Remote"]
_PLACES_SQL = "CASE CAST(c_custkey % 8 AS INTEGER) " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PLACES)) + " END"


def _places(spark: SparkSession, d: str) -> DataFrame:
    place = F.get(F.array(*map(F.lit, PLACES)), (F.col("c_custkey") % 8).cast("int"))
    return table(spark, d, "customer").select("c_custkey", place.alias("location"))


def _where(name: str, pattern: str, keep_null: bool):
    sql = f"SELECT c_custkey, location FROM (SELECT c_custkey, {_PLACES_SQL} AS location FROM customer) WHERE regexp_matches(location, '{pattern}')" + (" OR location IS NULL" if keep_null else "")

    def f(spark: SparkSession, d: str) -> DataFrame:
        hit = F.col("location").rlike(pattern)
        return _places(spark, d).filter(hit | F.col("location").isNull() if keep_null else hit)

    f.__name__ = name
    query(sql)(f)


_where("us_filter_names_anywhere", "Texas|Idaho|Georgia", False)
_where("us_filter_names", ",\\s*(Texas|Idaho|Georgia)\\b|United States", True)
_where("us_filter_codes", ",\\s*(TX|ID|GA)\\b", True)
_where("us_filter_country", "(?i)united states", False)
_where("state_code_filter", "US-TX", False)
_where("state_list_filter", "(?i)texas|idaho", True)


@query("SELECT page_id, path FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/job/Boise-ID---Main-Site/' || page_id ELSE '/job/Taichung---MTB-Taiwan/' || page_id END AS path FROM pages) WHERE regexp_matches(path, '/job/[^/]*-(ID|TX)---')")
def us_filter_path(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("page_id")
    path = F.when(k % 2 == 0, F.concat(F.lit("/job/Boise-ID---Main-Site/"), k.cast("string"))).otherwise(F.concat(F.lit("/job/Taichung---MTB-Taiwan/"), k.cast("string")))
    return table(spark, d, "pages").select("page_id", path.alias("path")).filter(F.col("path").rlike("/job/[^/]*-(ID|TX)---"))


@query("SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) > 20 AND NOT regexp_matches(x, '(?i)copyright|license')), '|') AS kept FROM documents")
def line_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(L.keep_lines(L.lines_of(F.col("text")), 20, "(?i)copyright|license"), "|").alias("kept"))


_TITLES = "list_value('Bachelor degree in ' || p_type, CAST(p_size AS VARCHAR) || ' years with ' || p_name, p_name, p_name, 'experience of ' || p_brand)"


def _titles(spark: SparkSession, d: str) -> DataFrame:
    lines = F.array(F.concat(F.lit("Bachelor degree in "), "p_type"), F.concat(F.col("p_size").cast("string"), F.lit(" years with "), "p_name"), F.col("p_name"), F.col("p_name"), F.concat(F.lit("experience of "), "p_brand"))
    return table(spark, d, "part").select("p_partkey", lines.alias("lines"))


@query(f"SELECT p_partkey, l[1] AS education, l[2] || '|' || l[5] AS experience, l[3] || '|' || l[4] AS other FROM (SELECT p_partkey, {_TITLES} AS l FROM part)")
def line_partition(spark: SparkSession, d: str) -> DataFrame:
    rows = _titles(spark, d).select("p_partkey", L.partition_lines(F.col("lines")).alias("x"))
    return rows.select("p_partkey", *[F.array_join(f"x.{c}", "|").alias(c) for c in ("education", "experience", "other")])


@query(f"SELECT p_partkey, l[1] || '|' || l[2] || '|' || l[3] || CASE WHEN length(l[3]) <= 20 THEN '|' || l[4] ELSE '' END || '|' || l[5] AS kept FROM (SELECT p_partkey, {_TITLES} AS l FROM part) WHERE length(l[2]) > 20 OR true")
def line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return _titles(spark, d).select("p_partkey", F.array_join(L.dedup_lines(F.col("lines")), "|").alias("kept"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Degree in ' || p_brand END AS education, CASE WHEN p_partkey % 2 = 0 THEN p_size || ' years' END AS experience FROM part")
def or_split(spark: SparkSession, d: str) -> DataFrame:
    line = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Degree in "), "p_brand", F.lit(" - OR -  "), F.col("p_size").cast("string"), F.lit(" years"))).otherwise(F.concat(F.lit("Only "), "p_brand"))
    return table(spark, d, "part").select("p_partkey", L.or_split(F.array(line)).alias("x")).select("p_partkey", "x.*")


@query("SELECT p_partkey, 'MSEE|' || p_size || ' years of design|' || p_name AS bullets FROM part")
def bullet_expand(spark: SparkSession, d: str) -> DataFrame:
    lines = F.array(F.concat(F.lit("MSEE + "), F.col("p_size").cast("string"), F.lit(" years of design")), F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", F.array_join(L.expand_bullets(lines), "|").alias("bullets"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'given' ELSE 'Master of ' || p_brand END AS education, CASE WHEN p_partkey % 2 = 0 THEN p_name || '|Master of ' || p_brand ELSE p_name END AS preferred FROM part")
def promote_lines(spark: SparkSession, d: str) -> DataFrame:
    preferred = F.array(F.col("p_name"), F.concat(F.lit("Master of "), "p_brand"))
    rows = table(spark, d, "part").select("p_partkey", L.promote(preferred, F.when(F.col("p_partkey") % 2 == 0, "given")).alias("x"))
    return rows.select("p_partkey", "x.education", F.array_join("x.preferred", "|").alias("preferred"))
