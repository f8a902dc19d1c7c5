"""Queries over captured payloads: JSON listings, HTML pages, sitemaps and sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import details as D
from millrace.operators.spread import spread
from millrace.registry import query, table
from millrace.sources.captured import embedded_json as embedded
from millrace.sources.captured import listing, sitemap_urls


@query("SELECT l_orderkey, first(n_name ORDER BY l_linenumber, n_name) AS place FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1 GROUP BY 1")
def nested_first_match(spark: SparkSession, d: str) -> DataFrame:
    """The first nested location of one region; an order's line items are few by the schema."""
    place = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name", "n_regionkey")
    rows = table(spark, d, "lineitem").join(place, F.col("l_suppkey") == F.col("s_suppkey"))
    nested = rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "n_name", "n_regionkey"))).alias("places"))
    first = F.get(F.filter("places", lambda p: p["n_regionkey"] == 1), 0)
    return nested.select("l_orderkey", first["n_name"].alias("place")).filter("place is not null")


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand FROM part")
def kv_lookup(spark: SparkSession, d: str) -> DataFrame:
    """An attribute by name from name-value pairs."""
    pairs = F.array(F.struct(F.lit("type").alias("name"), F.col("p_type").alias("value")), F.struct(F.when(F.col("p_partkey") % 2 == 0, "brand").otherwise("other").alias("name"), F.col("p_brand").alias("value")))
    return table(spark, d, "part").select("p_partkey", F.try_element_at(F.map_from_entries(pairs), F.lit("brand")).alias("brand"))


@query("SELECT p_partkey, p_brand || ', ' || p_type AS categories FROM part")
def array_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array("p_brand", F.lit(None), "p_type"), ", ").alias("categories"))


@query("SELECT o_orderkey, o_orderstatus AS title, o_orderpriority AS location FROM orders UNION ALL SELECT o_orderkey, 'second', NULL FROM orders WHERE o_orderkey % 2 = 0")
def json_listing_explode(spark: SparkSession, d: str) -> DataFrame:
    one = F.struct(F.col("o_orderstatus").alias("title"), F.col("o_orderpriority").alias("locationsText"))
    two = F.when(F.col("o_orderkey") % 2 == 0, F.array(one, F.struct(F.lit("second").alias("title"), F.lit(None).cast("string").alias("locationsText")))).otherwise(F.array(one))
    pages = table(spark, d, "orders").select("o_orderkey", F.to_json(F.struct(F.lit(7).alias("total"), two.alias("jobPostings"))).alias("body"))
    job = listing(F.col("body"), "total int, jobPostings array<struct<title string, locationsText string>>", "jobPostings")
    return pages.select("o_orderkey", job.alias("j")).select("o_orderkey", "j.title", F.col("j.locationsText").alias("location"))


@query("SELECT n_nationkey, r_name AS facet_id FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey = 1")
def facet_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The id of a facet value by its label, from nested facets."""
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    value = F.struct(F.col("r_name").alias("id"), F.when(F.col("n_regionkey") == 1, "United States of America").otherwise("Other").alias("descriptor"))
    facets = F.to_json(F.struct(F.array(F.struct(F.lit("country").alias("facetParameter"), F.array(value).alias("values"))).alias("facets")))
    facet = listing(facets, "facets array<struct<facetParameter string, values array<struct<id string, descriptor string>>>>", "facets")
    values = rows.select("n_nationkey", facet.alias("f")).select("n_nationkey", F.explode("f.values").alias("v"))
    return values.filter(F.col("v.descriptor").contains("United States")).select("n_nationkey", F.col("v.id").alias("facet_id"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT p_partkey, p_name AS title FROM part WHERE p_partkey % 3 <> 0")
def embedded_json(spark: SparkSession, d: str) -> DataFrame:
    """A page's script JSON; placeholder titles are dropped."""
    data = F.to_json(F.struct(F.struct(F.struct(F.when(F.col("p_partkey") % 3 == 0, "Job Details").otherwise(F.col("p_name")).alias("jobTitle")).alias("jobData")).alias("pageProps")))
    html = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script></html>"))
    title = F.get_json_object(embedded(html, "__NEXT_DATA__"), "$.pageProps.jobData.jobTitle")
    return table(spark, d, "part").select("p_partkey", title.alias("title")).filter(~F.trim("title").isin("Job Details", "Job Posting", ""))


@query("SELECT p_partkey, 'https://x.example/jobs/' || p_partkey AS url FROM part")
def sitemap_xpath(spark: SparkSession, d: str) -> DataFrame:
    xml = F.concat(F.lit("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'><url><loc>https://x.example/jobs/"), F.col("p_partkey").cast("string"), F.lit("</loc></url><url><loc>https://x.example/about</loc></url></urlset>"))
    return table(spark, d, "part").select("p_partkey", F.explode(sitemap_urls(xml, r"/jobs/\d+")).alias("url"))


@query("SELECT p_partkey, p_brand AS title FROM part WHERE p_partkey % 2 = 0")
def jsonld_first(spark: SparkSession, d: str) -> DataFrame:
    post = F.to_json(F.struct(F.when(F.col("p_partkey") % 2 == 0, "JobPosting").otherwise("Person").alias("@type"), F.col("p_brand").alias("title")))
    html = F.concat(F.lit('<script type="application/ld+json">{"@type":"Organization"}</script><script type="application/ld+json">'), post, F.lit("</script>"))
    return spread(table(spark, d, "part")).select("p_partkey", F.get_json_object(D.first_jsonld(html), "$.title").alias("title")).filter("title is not null")


@query("SELECT page_id, CAST(len(string_split(html, '<li>')) - 1 AS INTEGER) AS items FROM pages")
def list_item_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.size(D.list_items("html")).alias("items"))


@query("SELECT page_id, CAST(unnest(range(1, len(m) + 1)) AS INTEGER) AS n, unnest(m) AS href FROM (SELECT page_id, regexp_extract_all(html, '<a href=\"([^\"]+)\"', 1) AS m FROM pages)")
def html_link_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.posexplode(D.link_list("html")).alias("k", "a")).select("page_id", (F.col("k") + 1).alias("n"), F.col("a.href").alias("href"))


@query("""WITH l AS (SELECT doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x: trim(x))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM documents),
h AS (SELECT *, CASE WHEN length(line) <= 30 THEN line END AS heading FROM l WHERE line <> ''),
s AS (SELECT *, last_value(heading IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS section FROM h)
SELECT doc_id, CAST(k AS INTEGER) AS k, section, CAST(length(line) AS INTEGER) AS n FROM s WHERE heading IS NULL""")
def carry_forward_sections(spark: SparkSession, d: str) -> DataFrame:
    """Each line under the last short line before it."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.transform(F.split("text", "\n"), lambda x: F.trim(x))).alias("k", "line")).filter("line <> ''")
    lines = lines.withColumn("heading", F.when(F.length("line") <= 30, F.col("line")))
    up_to = Window.partitionBy("doc_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.last("heading", True).over(up_to)).filter("heading is null").select("doc_id", "k", "section", F.length("line").alias("n"))


PLATFORMS = ["workday", "oracle", "successfactors", "talentbrew", "icims", "dayforce", "boeing"]


def _posting(n: Column, brand: Column, name: Column) -> Column:
    """A posting whose parts are known: duties, two requirements, a preference and pay."""
    head = [r"Responsibilities", "Responsibilities include", "Key Responsibilities", "What You&rsquo;ll Be Doing", "The Role", "Responsibilities", "Position Responsibilities"]
    need = ["Minimum Qualifications", "Minimum requirements", "Required Qualifications", "What You&rsquo;ll Need", "Qualifications", "Required Qualifications", "Basic Qualifications"]
    want = ["Preferred Qualifications"] * 4 + ["Preferred Experience"] + ["Preferred Qualifications"] * 2
    at = (n % 7).cast("int")
    pick = lambda xs: F.get(F.array(*map(F.lit, xs)), at)
    return F.concat(F.lit("<div><h3>"), pick(head), F.lit("</h3><ul><li>Build "), name, F.lit("<li>Run "), brand, F.lit("</ul><h3>"), pick(need), F.lit("</h3><ul><li>Bachelor in "), brand, F.lit("</li><li>5 years of experience with "), name, F.lit("</li></ul><p><b>"), pick(want), F.lit("</b></p><ul><li>Likes "), brand, F.lit("</ul><p>Pay is $10,000 - $20,000 a year</p></div>"))


@query("""SELECT p_partkey, p_platform AS platform, 'Build ' || trim(p_name) || chr(10) || 'Run ' || p_brand AS job_responsibilities,
CASE WHEN p_platform = 'oracle' THEN 'Bachelor in ' || p_brand || chr(10) || '5 years of experience with ' || p_name ELSE 'Bachelor in ' || p_brand END AS min_education,
CASE WHEN p_platform <> 'oracle' THEN '5 years of experience with ' || p_name END AS min_experience,
CASE WHEN p_platform <> 'talentbrew' THEN 'Likes ' || p_brand || CASE WHEN p_platform IN ('dayforce', 'boeing') THEN chr(10) || 'Pay is $10,000 - $20,000 a year' ELSE '' END END AS preferred_qualifications, '$10,000 - $20,000' AS salary_range
FROM (SELECT *, (['workday', 'oracle', 'successfactors', 'talentbrew', 'icims', 'dayforce', 'boeing'])[CAST(p_partkey % 7 AS INTEGER) + 1] AS p_platform FROM part)""")
def detail_record(spark: SparkSession, d: str) -> DataFrame:
    """Fields of postings of all platforms in one pass."""
    platform = F.get(F.array(*map(F.lit, PLATFORMS)), (F.col("p_partkey") % 7).cast("int"))
    rows = spread(table(spark, d, "part")).select("p_partkey", platform.alias("platform"), _posting(F.col("p_partkey"), F.col("p_brand"), F.col("p_name")).alias("html"))
    return rows.select("p_partkey", "platform", D.detail_record("platform", "html").alias("r")).select("p_partkey", "platform", "r.job_responsibilities", "r.min_education", "r.min_experience", "r.preferred_qualifications", "r.salary_range")


@query()
def rendered_pages(spark: SparkSession, d: str) -> DataFrame:
    lines = D.rendered_lines("html")
    return table(spark, d, "pages").select("page_id", lines.alias("lines")).select("page_id", F.size("lines").alias("n_lines"), F.array_join("lines", "\n").alias("text"))


@query()
def prose_fallback(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", D.prose_text("html").alias("prose"))


@query("SELECT p_partkey, 'St. ' || p_brand || chr(8217) || 's ' || chr(8594) || ' x' AS name FROM part")
def byte_repair(spark: SparkSession, d: str) -> DataFrame:
    """A byte that is no UTF-8 becomes its cp1252 character; valid ones that contain it stay."""
    raw = F.concat(F.encode(F.concat(F.lit("St. "), "p_brand"), "utf-8"), F.unhex(F.lit("92")), F.encode(F.lit("s → x"), "utf-8"))
    return spread(table(spark, d, "part")).select("p_partkey", D.repaired(raw).alias("name"))


@query("SELECT p_partkey, 'Duties of ' || p_brand AS duties, CAST(p_size AS VARCHAR) || ' years' AS experience FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'Duties of ' || p_brand, NULL FROM part WHERE p_partkey % 2 = 1")
def regex_sections(spark: SparkSession, d: str) -> DataFrame:
    """Fields of short plain text by labels; each ends at the next label."""
    text = F.concat(F.lit("Responsibilities: Duties of "), "p_brand", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" Experience: "), F.col("p_size").cast("string"), F.lit(" years"))).otherwise(""), F.lit(" Education: none"))
    field = lambda name: F.when(text.rlike(rf"{name}: "), F.regexp_extract(text, rf"{name}: (.*?)(?= (?:Experience|Education): |$)", 1))
    return table(spark, d, "part").select("p_partkey", field("Responsibilities").alias("duties"), field("Experience").alias("experience"))


@query("SELECT p_partkey, 'Bachelor in ' || p_brand AS required, CASE WHEN p_partkey % 2 = 0 THEN 'Master in ' || p_type END AS preferred FROM part")
def credential_split(spark: SparkSession, d: str) -> DataFrame:
    """A credential line into the required degree and the one marked as preferred."""
    line = F.concat(F.lit("Bachelor in "), "p_brand", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" required, Master in "), "p_type", F.lit(" (preferred)"))).otherwise(" required"))
    preferred = F.when(line.rlike(r"\(preferred\)"), F.regexp_extract(line, r"(Master[^,]*?)\s*\(preferred\)", 1))
    return table(spark, d, "part").select("p_partkey", F.regexp_extract(line, r"^(Bachelor.*?) required", 1).alias("required"), preferred.alias("preferred"))


@query("SELECT p_partkey, 'Work on ' || trim(p_name) AS body FROM part")
def boilerplate_strip(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("About us we are many. About the job"), F.lit(""), F.lit(" #LI-AB1"), F.lit("\nWork on "), F.trim("p_name"), F.lit("\nWe are an Equal Opportunity Employer and so on."))
    lines = F.filter(F.transform(F.split(D.stripped(text), "\n"), lambda x: F.trim(x)), lambda x: x.startswith("Work"))
    return spread(table(spark, d, "part")).select("p_partkey", F.get(lines, 0).alias("body"))


@query("SELECT p_partkey, 'As a ' || p_brand || ' engineer you will build ' || trim(p_name) || '.' AS summary FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey % 3 = 0")
def role_summary(spark: SparkSession, d: str) -> DataFrame:
    """The first paragraph that introduces the role, over 30 characters."""
    intro = F.when(F.col("p_partkey") % 3 == 0, "<p>Hello.</p>").otherwise(F.concat(F.lit("<p>Short one</p><p>As a "), "p_brand", F.lit(" engineer you will build "), F.trim("p_name"), F.lit(".</p>")))
    first = F.get(F.filter(D.rendered_lines(intro), lambda x: (F.length(x) > 30) & x.rlike(r"(?i)^(?:as an? |in this role|the role|you will|this position)")), 0)
    return spread(table(spark, d, "part")).select("p_partkey", first.alias("summary"))


@query("SELECT p_partkey, 'Build ' || trim(p_name) || '|Run ' || p_brand AS duties FROM part")
def html_sections(spark: SparkSession, d: str) -> DataFrame:
    html = F.concat(F.lit("<p>Intro</p><h2>Duties</h2><p>lead</p><ul><li>Build "), "p_name", F.lit("</li><li>Run "), "p_brand", F.lit("</li></ul><h2>Other</h2><ul><li>no</li></ul>"))
    return spread(table(spark, d, "part")).select("p_partkey", F.array_join(D.section_lines(html), "|").alias("duties"))
