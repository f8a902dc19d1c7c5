"""Queries from files and listings: CSV exports, listing pages of each platform, places, pay and run records.

Payloads are built from table columns, so that SQL over the same columns tells what the readers must find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import store, supply
from millrace.operators.ingest import in_country, ingest, latest_exports
from millrace.operators.spread import spread
from millrace.registry import query, table
from millrace.sources import captured, listings
from millrace.sources.workspace import workspace


def _text(*parts: str | Column) -> Column:
    """Literal strings and columns, joined."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query("SELECT n_nationkey AS dim_id, n_name || ', ' || chr(10) || 'a \"quoted\" place' AS name, CASE WHEN n_nationkey % 3 <> 0 THEN n_regionkey END AS region FROM nation")
def csv_title_skip(spark: SparkSession, d: str) -> DataFrame:
    """Exports with a title line, quoted line ends and a comma at each record's end, one file for each region."""
    name = _text('"', F.col("n_name"), ', \na ""quoted"" place"')
    line = _text(F.col("n_nationkey"), ",", name, ",", F.when(F.col("n_nationkey") % 3 != 0, F.col("n_regionkey").cast("string")).otherwise(""), ",")
    files = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
    path = workspace(spark, "titled")
    files.select("n_regionkey", F.concat(F.lit("Report of all places,\nDimId,Name,Region,\n"), "lines").alias("value")).write.partitionBy("n_regionkey").option("lineSep", "\n").text(path)
    return captured.read_titled_csv(spark, f"{path}/*/*.txt", "dim_id int, name string, region int")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier UNION ALL SELECT c_custkey, c_name, NULL FROM customer")
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    """CSV files whose headers differ in order and in columns."""
    path = workspace(spark, "by-name")
    table(spark, d, "supplier").select("s_acctbal", "s_suppkey", "s_name", "s_nationkey").write.option("header", True).csv(path)
    table(spark, d, "customer").select(F.col("c_name").alias("s_name"), F.col("c_custkey").alias("s_suppkey")).write.mode("append").option("header", True).csv(path)
    return captured.read_by_name(spark, path, "s_suppkey bigint, s_name string, s_acctbal double").drop("path")


@query("SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS amount FROM lineitem")
def select_rename(spark: SparkSession, d: str) -> DataFrame:
    return supply.select_rename(table(spark, d, "lineitem"), {"l_orderkey": "order_id", "l_linenumber": "line", "l_quantity": "amount"})


@query("SELECT CAST(c_custkey AS VARCHAR) AS job_identification, c_name FROM customer")
def cast_if_present(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("job_identification"), "c_name")
    return supply.cast_if_present(rows, {"job_identification": "string", "not_there": "int"})


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def store_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A combined frame written as Parquet and read again."""
    path = workspace(spark, "combined")
    table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice").write.parquet(path)
    return spark.read.parquet(path)


@query("""SELECT o_orderkey, o_orderstatus, slug, day FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority LIKE '1%' THEN 'nxp' ELSE trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '_') END AS slug,
CASE WHEN o_orderstatus = 'F' THEN '19980701' ELSE '19980802' END AS day FROM orders) QUALIFY day = max(day) OVER (PARTITION BY slug)""")
def latest_company_exports(spark: SparkSession, d: str) -> DataFrame:
    """Two days of exports for each company; the later ones are combined, aliases counting as their company."""
    path = workspace(spark, "exports")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    name = F.when(F.col("o_orderpriority").startswith("1"), F.when(F.col("o_orderstatus") == "F", "nxp").otherwise("nxp_semiconductors")).otherwise(S.slug(F.col("o_orderpriority")))
    first, last = F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"
    captured.write_company_exports(rows.filter(first), path, "19980701", name)
    captured.write_company_exports(rows.filter(last), path, "19980802", name)
    found = captured.read_company_exports(spark, path, "o_orderkey bigint, o_orderstatus string, o_orderpriority string")
    return latest_exports(found).select("o_orderkey", "o_orderstatus", "slug", "day")


PLACES = ["Austin, Texas", "Boise, ID", "Austin, United States", "Tbilisi, Georgia", "Paris, France", "US-TX-Austin", "United States-Maryland-Baltimore", None]
_PLACE_SQL = "(['Austin, Texas', 'Boise, ID', 'Austin, United States', 'Tbilisi, Georgia', 'Paris, France', 'US-TX-Austin', 'United States-Maryland-Baltimore', NULL])[CAST(c_custkey % 8 AS INTEGER) + 1]"


def _country(name: str, platform: str, company: str, where: str, filters: tuple[str, list[str], bool] | None = None) -> None:
    """A query that applies one platform's rule to places of many shapes."""

    def f(spark: SparkSession, d: str) -> DataFrame:
        k = F.col("c_custkey")
        place = F.get(F.array(*[F.lit(p) for p in PLACES]), (k % 8).cast("int"))
        path = F.when(k % 3 == 0, "/job/Boise-ID---Main-Site/x").when(k % 3 == 1, "/job/Taichung---MTB-Taiwan/ENGINEER-ME-FST").otherwise(None)
        rows = table(spark, d, "customer").select("c_custkey", place.alias("location"), path.alias("path"))
        given = F.struct(F.lit(filters[0]).alias("q"), F.array(*map(F.lit, filters[1])).cast("array<string>").alias("states"), F.lit(filters[2]).alias("country_facet")) if filters else None
        return rows.filter(in_country(F.lit(platform), F.col("location"), F.lit(company), F.col("path"), given)).select("c_custkey", "location")

    f.__name__ = name
    query(f"SELECT c_custkey, location FROM (SELECT c_custkey, {_PLACE_SQL} AS location FROM customer) WHERE {where}")(f)


_country("country_boeing", "boeing", "Boeing", "location IN ('Austin, Texas', 'Tbilisi, Georgia', 'United States-Maryland-Baltimore')")
_country("country_talentbrew", "talentbrew", "X", "location IS NULL OR location IN ('Austin, Texas', 'Tbilisi, Georgia', 'Austin, United States', 'United States-Maryland-Baltimore')")
_country("country_tsmc", "successfactors", "TSMC", "location IS NULL OR location IN ('Boise, ID', 'Austin, United States', 'US-TX-Austin', 'United States-Maryland-Baltimore')")
_country("country_successfactors", "successfactors", "Lam", "true")
_country("country_icims", "icims", "AMD", "contains(location, 'United States')")
_country("country_workday", "workday", "Micron", "location IS NULL OR location = 'Boise, ID' OR c_custkey % 3 = 0")
_country("country_workday_facet", "workday", "Micron", "true", ("", [], True))
_country("country_workday_search", "workday", "TIE", "location IS NULL OR contains(location, 'US-TX')", ("TX", [], False))
_country("country_workday_states", "workday", "NG", "location IS NULL OR contains(location, 'Maryland') OR contains(location, 'Texas')", ("", ["maryland", "texas"], False))


@query("""SELECT o_orderkey, o_orderstatus AS title, CASE o_orderkey % 4 WHEN 0 THEN 'Austin, TX' WHEN 1 THEN 'Austin' WHEN 2 THEN 'TX' ELSE 'United States' END AS location, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS posted
FROM orders WHERE o_orderkey % 5 <> 0""")
def oracle_listing(spark: SparkSession, d: str) -> DataFrame:
    """Requisitions with a place in the country, which need not be their first one."""
    k = F.col("o_orderkey")
    abroad = F.struct(F.lit("FR").alias("Country"), F.lit("Paris").alias("TownOrCity"), F.lit("").alias("Region2"))
    here = F.struct(F.when(k % 5 == 0, "DE").otherwise("US").alias("Country"), F.when((k % 4).isin(0, 1), "Austin").otherwise("").alias("TownOrCity"), F.when((k % 4).isin(0, 2), "TX").alias("Region2"))
    one = F.struct(k.cast("string").alias("Id"), F.col("o_orderstatus").alias("Title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("PostedDate"), F.array(abroad, here).alias("workLocation"))
    nameless = F.struct(F.lit("0").alias("Id"), F.lit(None).cast("string").alias("Title"), F.lit("").alias("PostedDate"), F.array(here).alias("workLocation"))
    body = F.to_json(F.struct(F.array(F.struct(F.lit(2).alias("TotalJobsCount"), F.array(one, nameless).alias("requisitionList"))).alias("items")))
    return table(spark, d, "orders").select("o_orderkey", F.explode(captured.oracle_listing(body)).alias("j")).select("o_orderkey", "j.title", "j.location", "j.posted")


_DAY = "CAST(o_orderdate AS DATE)"


@query(f"SELECT o_orderkey, o_orderstatus || ' & co' AS job_title, o_orderpriority AS location, 'https://t.example/job/' || o_orderkey AS job_url, CASE WHEN o_orderkey % 3 <> 0 THEN CAST({_DAY} AS VARCHAR) END AS posting_date FROM orders")
def talentbrew_listing(spark: SparkSession, d: str) -> DataFrame:
    """JSON around a fragment of list items; items without a marked link or a title are none."""
    posted = F.when(F.col("o_orderkey") % 3 != 0, _text("<span class='d'>Posted: ", F.date_format("o_orderdate", "MM/dd/yyyy"), "</span>")).otherwise("")
    html = _text("<ul><li><a href='/save'>Save</a></li>\n<li class='x'><a class='sr-job-link' href='/job/", F.col("o_orderkey"), "'><h2> ", F.col("o_orderstatus"), "\n &amp; co</h2><span>", F.col("o_orderpriority"), "</span><span>Cat</span>", posted, "</a></li><li><a class='sr-job-link' href='/job/0'><h2> </h2></a></li></ul>")
    body = F.to_json(F.struct(F.lit(True).alias("hasJobs"), html.alias("results")))
    items = listings.result_items(captured.results_html(body), F.lit("https://t.example"))
    rows = spread(table(spark, d, "orders")).select("o_orderkey", F.explode(items).alias("j")).select("o_orderkey", "j.*")
    return rows.withColumn("posting_date", F.col("posting_date").cast("string"))


@query(f"SELECT o_orderkey, o_orderstatus AS job_title, o_orderpriority AS location, 'https://b.example/job/' || o_orderkey AS job_url, CAST({_DAY} AS VARCHAR) AS posting_date FROM orders UNION ALL SELECT o_orderkey, 'Second', NULL, 'https://b.example/job/s' || o_orderkey, NULL FROM orders WHERE o_orderkey % 2 = 0")
def boeing_listing(spark: SparkSession, d: str) -> DataFrame:
    """Links with their own titles; links that aren't postings stand between them."""
    second = F.when(F.col("o_orderkey") % 2 == 0, _text("<a href='/job/s", F.col("o_orderkey"), "'><span>Second</span></a>")).otherwise("")
    html = _text("<a href='/save'><span>Save</span><span>it</span></a><a href='/job/", F.col("o_orderkey"), "'><span>", F.col("o_orderstatus"), "</span></a> <span class='location'>", F.col("o_orderpriority"), "</span><span class='date'>", F.date_format("o_orderdate", "MM/dd/yyyy"), "</span>", second)
    rows = spread(table(spark, d, "orders")).select("o_orderkey", F.explode(listings.job_links(html, F.lit("https://b.example"))).alias("j")).select("o_orderkey", "j.*")
    return rows.withColumn("posting_date", F.col("posting_date").cast("string"))


@query("SELECT o_orderkey, o_orderstatus AS job_title, o_orderpriority AS location, 'https://s.example/job/' || o_orderkey AS job_url FROM orders")
def successfactors_listing(spark: SparkSession, d: str) -> DataFrame:
    """Rows with classes or plain table rows; a header row is none."""
    k = F.col("o_orderkey")
    marked = _text("<table><tr><th>Title</th></tr><tr class='data-row'><td><a class='jobTitle-link' href='https://s.example/job/", k, "'>", F.col("o_orderstatus"), "</a></td><td><span class='jobLocation'> ", F.col("o_orderpriority"), "</span></td></tr></table>")
    plain = _text("<table class='jobs'><tr><td>Title</td></tr><tr><td><a href='/about'>x</a><a href='/job/", k, "'>", F.col("o_orderstatus"), "</a></td><td>", F.col("o_orderpriority"), "</td></tr></table>")
    rows = listings.table_rows(F.when(k % 2 == 0, marked).otherwise(plain), F.lit("https://s.example"))
    return spread(table(spark, d, "orders")).select("o_orderkey", F.explode(rows).alias("j")).select("o_orderkey", "j.job_title", "j.location", "j.job_url")


@query("SELECT p_partkey, p_brand AS title, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE '$' || p_size || ',000-$' || (p_size + 9) || ',000' END AS pay FROM part WHERE p_partkey % 4 <> 3")
def script_config(spark: SparkSession, d: str) -> DataFrame:
    """The object that a page's script assigns, ended by the script or by the next statement, and the pay in its tags."""
    k = F.col("p_partkey")
    tags = F.when(k % 3 != 0, F.array(_text("USD $", F.col("p_size"), ",000.00/Yr.")))
    job = F.to_json(F.struct(F.struct(F.col("p_brand").alias("title"), tags.alias("tags5"), F.when(k % 3 != 0, F.array(_text("USD $", F.col("p_size") + 9, ",000.00/Yr."))).alias("tags6"), F.lit("<p>a};b</p>").alias("description")).alias("job")))
    html = F.when(k % 4 == 3, "<script>var x = {};</script>").otherwise(_text("<script>window.jobDescriptionConfig = ", job, F.when(k % 4 == 1, "; </script>").otherwise(";\nvar y = 1;")))
    config = captured.script_json(html, r"window\.jobDescriptionConfig")
    value = lambda path: F.get_json_object(config, path)
    pay = S.icims_pay(value("$.job.tags5[0]"), value("$.job.tags6[0]"), value("$.job.description"))
    return table(spark, d, "part").select("p_partkey", value("$.job.title").alias("title"), pay.alias("pay")).filter("title is not null")


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '$' || p_size || '-$' || (p_size + 5) WHEN 1 THEN '$' || p_size || '.00-$' || (p_size + 5) || '.50/hr' WHEN 2 THEN '$' || p_size || '+' END AS icims,
CASE p_partkey % 3 WHEN 0 THEN '$' || p_size || '-$' || (p_size + 5) WHEN 1 THEN '$1-$2' END AS talentbrew FROM part""")
def pay_by_platform(spark: SparkSession, d: str) -> DataFrame:
    """Pay texts that name a minimum and maximum, an hourly rate or a label."""
    k, low, high = F.col("p_partkey"), F.col("p_size"), F.col("p_size") + 5
    text = F.when(k % 4 == 0, _text("<p>Texas pay range: MIN $", low, " MIDPOINT $7 MAX $", high, "</p>")).when(k % 4 == 1, _text("Pay Range: $", low, ".00 Hourly - $", high, ".50 hourly")).when(k % 4 == 2, _text("salary range: MIN $", low)).otherwise("No pay")
    labels = F.when(k % 3 == 0, F.array(F.lit("Benefits"), _text("Base Salary Range: $", low, "-$", high))).when(k % 3 == 1, F.array(F.lit("Benefits"))).otherwise(F.array(F.lit("base salary range on request")))
    return table(spark, d, "part").select("p_partkey", S.icims_pay(F.lit(None).cast("string"), F.lit(None).cast("string"), text).alias("icims"), S.labelled_pay(labels, "Base Salary Range", F.lit("Rewards: $1-$2")).alias("talentbrew"))


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'acme' WHEN 1 THEN 'solo' END AS namespace, 'a&b ' || page_id AS q, CAST(page_id % 5 AS VARCHAR) || '|z' AS ids, CASE WHEN page_id % 2 = 0 THEN 'Ohio|Iowa' ELSE '' END AS states FROM pages")
def listing_urls(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("page_id")
    board = F.when(k % 3 == 0, "https://jobs.dayforcehcm.com/en-US/Acme/CANDIDATEPORTAL").when(k % 3 == 1, "https://jobs.dayforcehcm.com/SOLO/").otherwise("https://jobs.example.com/x/y/")
    careers = _text("https://c.example/site?q=a%26b+", k, "&facet_jobFamily=", k % 5, ",z", F.when(k % 2 == 0, "&states=Ohio,Iowa").otherwise(""), "#top")
    f = S.listing_filters(careers)
    return table(spark, d, "pages").select("page_id", S.dayforce_namespace(board).alias("namespace"), f["q"].alias("q"), F.array_join(f["facets"]["jobFamily"], "|").alias("ids"), F.array_join(f["states"], "|").alias("states"))


@query("""SELECT CAST(s_suppkey AS BIGINT) AS company_id, s_name AS company_name FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT m + row_number() OVER (ORDER BY s_name), s_name FROM supplier, (SELECT max(s_suppkey) AS m FROM supplier WHERE s_suppkey % 2 = 0) WHERE s_suppkey % 2 = 1""")
def numbered_companies(spark: SparkSession, d: str) -> DataFrame:
    """Unknown companies are added once each, numbered on from the greatest id."""
    rows = table(spark, d, "supplier")
    known = rows.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("bigint").alias("company_id"), F.col("s_name").alias("company_name"))
    new = rows.select(F.col("s_name").alias("company_name"))
    return store.add_companies(known, new.union(new), "company_name", "company_id")


@query("""SELECT 1 AS run_id, CAST(n_nationkey AS BIGINT) AS company_id, 'completed' AS status, 90.5 AS duration_seconds, 7 AS jobs_found FROM nation WHERE n_name = 'CHINA'
UNION ALL SELECT 2, CAST(n_nationkey AS BIGINT), 'running', NULL, NULL FROM nation WHERE n_name = 'JAPAN'""")
def run_start(spark: SparkSession, d: str) -> DataFrame:
    """Runs of companies that are looked up by name; one of them is closed."""
    companies = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("company_id"), F.col("n_name").alias("company_name"))
    runs = spark.createDataFrame([], "run_id int, company_id bigint, started_at timestamp, status string, error_message string, jobs_found int, jobs_new int, jobs_updated int")
    for i, name in enumerate(["CHINA", "JAPAN", "NOWHERE"], 1):
        runs = store.start_run(runs, companies, name, i, "2026-01-01 00:00:00")
    return store.finish_run(runs, 1, 7, 3, 4, completed="2026-01-01 00:01:30.5").select("run_id", "company_id", "status", "duration_seconds", "jobs_found")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_name = 'Customer#000000007'")
def company_by_name(spark: SparkSession, d: str) -> DataFrame:
    """The first company of a name."""
    return table(spark, d, "customer").filter(F.col("c_name") == "Customer#000000007").select("c_custkey", "c_name", "c_acctbal").limit(1)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0")
def company_config(spark: SparkSession, d: str) -> DataFrame:
    """A configuration file with a flag, read again for the active ones."""
    path = workspace(spark, "companies")
    table(spark, d, "customer").select("c_custkey", "c_name", (F.col("c_custkey") % 3 != 0).alias("active")).write.option("header", True).csv(path)
    return captured.read_companies(spark, path, "c_custkey bigint, c_name string, active boolean").drop("active")


@query("SELECT n_regionkey, CAST(n_nationkey AS VARCHAR) AS value, n_name AS text FROM nation WHERE n_nationkey % 4 <> 0")
def leaf_option_list(spark: SparkSession, d: str) -> DataFrame:
    """Options of a page's list; groups of institutions are left out."""
    one = F.struct(F.col("n_nationkey").cast("string").alias("Value"), F.col("n_name").alias("Text"), (F.col("n_nationkey") % 4 == 0).alias("IsGroup"))
    lists = table(spark, d, "nation").groupBy("n_regionkey").agg(F.to_json(F.collect_list(one)).alias("body"))
    return lists.select("n_regionkey", F.explode(captured.leaf_options(F.col("body"))).alias("o")).select("n_regionkey", "o.*")


@query("SELECT 'https://x.example/jobs/' || p_partkey AS job_url FROM part WHERE p_partkey % 3 <> 0")
def sitemap_index(spark: SparkSession, d: str) -> DataFrame:
    """An index of sitemaps, of which one isn't listed."""
    part = F.pmod(F.col("p_partkey"), F.lit(3))
    loc = _text("<url><loc>https://x.example/jobs/", F.col("p_partkey"), "</loc></url><url><loc>https://x.example/about/", F.col("p_partkey"), "</loc></url>")
    maps = table(spark, d, "part").groupBy(part.alias("k"), F.expr("p_partkey div 500").alias("n")).agg(F.array_join(F.collect_list(loc), "").alias("urls"))
    maps = maps.select("k", _text("https://x.example/map-", F.col("k"), "-", F.col("n"), ".xml").alias("url"), _text("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>", F.col("urls"), "</urlset>").alias("xml"))
    index = maps.filter("k <> 0").agg(F.array_join(F.collect_list(_text("<sitemap><loc>", F.col("url"), "</loc></sitemap>")), "").alias("all"))
    index = index.select(F.lit("https://x.example/sitemap.xml").alias("url"), _text("<sitemapindex>", F.col("all"), "</sitemapindex>").alias("xml"))
    return captured.crawl_sitemaps(maps.select("url", "xml").unionByName(index), "https://x.example/sitemap.xml", r"/jobs/\d+")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS category FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) BETWEEN 1994 AND 1996")
def dashboard_download(spark: SparkSession, d: str) -> DataFrame:
    """The filtered frame as a CSV download, read again."""
    rows = table(spark, d, "orders").filter(supply.in_years("o_orderdate", 1994, 1996)).select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("category"))
    path = workspace(spark, "download")
    captured.write_export(supply.dashboard_filter(rows, category="1-URGENT"), path)
    return spark.read.schema("o_orderkey bigint, year int, category string").option("header", True).csv(path)


@query("SELECT p_partkey, p_partkey % 4 IN (0, 1) AS hit FROM part")
def trade_keywords(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    text = F.when(k == 0, "a Mixed-Signal design").when(k == 1, "works on cmos.").when(k == 2, "fabric and chips").otherwise("icing, yielding")
    return table(spark, d, "part").select("p_partkey", S.has_keyword(text).alias("hit"))


@query("""SELECT p_partkey, 'build ' || p_brand AS job_responsibilities, CASE WHEN p_partkey % 2 = 0 THEN 'degree in ' || p_type END AS min_education, CASE WHEN p_partkey % 3 <> 0 THEN p_size || ' years' END AS min_experience,
CASE WHEN p_partkey % 2 = 1 THEN 'likes ' || p_type END AS preferred_qualifications, '$' || p_size || ' - $' || (p_size + 1) AS salary_range FROM part""")
def text_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields of plain texts by their labels, in any order and case."""
    k = F.col("p_partkey")
    text = _text("RESPONSIBILITIES: build ", F.col("p_brand"), " Requirements:", F.when(k % 2 == 0, _text(" Education: degree in ", F.col("p_type"))).otherwise(""), F.when(k % 3 != 0, _text(" Experience: ", F.col("p_size"), " years")).otherwise(""), " Skills none", F.when(k % 2 == 1, _text(" Nice to have: likes ", F.col("p_type"))).otherwise(""), " Salary range: $", F.col("p_size"), " - $", F.col("p_size") + 1, "  Benefits: all")
    return table(spark, d, "part").select("p_partkey", S.labelled_fields(text).alias("f")).select("p_partkey", "f.*")


@query("""SELECT 'u' || p_partkey AS job_url, 'C' || p_partkey % 5 AS company_name, p_name AS job_title, 'Austin, Texas' AS location, '2026-01-02' AS posting_date, 'Build ' || p_brand AS job_responsibilities,
CASE WHEN p_partkey % 2 = 0 THEN 'Bachelor of ' || p_type END AS min_education, CASE WHEN p_partkey % 2 = 1 THEN 'Knows ' || p_type END AS min_experience, 'R-' || p_partkey AS job_identification FROM part WHERE p_partkey % 7 <> 0""")
def ingest_batch(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of several platforms into an empty store; a listing that comes twice is one posting."""
    k = F.col("p_partkey")
    platform = F.when(k % 3 == 0, "boeing").when(k % 3 == 1, "talentbrew").otherwise("dayforce")
    head = F.when(k % 3 == 0, "Position Responsibilities").when(k % 3 == 1, "What You'll Be Doing").otherwise("Responsibilities")
    need = F.when(k % 3 == 0, "Basic Qualifications").when(k % 3 == 1, "What You'll Need").otherwise("Required Qualifications")
    line = F.when(k % 2 == 0, _text("Bachelor of ", F.col("p_type"))).otherwise(_text("Knows ", F.col("p_type")))
    body = _text("<h3>", head, "</h3><ul><li>Build ", F.col("p_brand"), "</ul><h3>", need, "</h3><ul><li>", line, "</ul>")
    place = F.when((k % 7 == 0) & (k % 3 < 2), "Paris, France").otherwise("Austin, Texas")
    rows = spread(table(spark, d, "part").filter((k % 7 != 0) | (k % 3 < 2)))
    rows = rows.select(platform.alias("platform"), _text("C", k % 5).alias("company_name"), _text("u", k).alias("url"), F.col("p_name").alias("title"), place.alias("location"), body.alias("body"), F.lit("Posted: 01/02/2026").alias("posted"), k.alias("ord"), _text("R-", k).alias("job_identification"), F.lit("2026-03-31").cast("date").alias("as_of"))
    empty = spark.createDataFrame([], "job_url string, company_name string, job_title string, location string, posting_date date")
    again = rows.withColumns({"ord": F.col("ord") - 1_000_000_000, "title": F.lit("older"), "company_name": F.col("company_name")})
    out = ingest(empty, rows.unionByName(again))
    return out.select("job_url", "company_name", "job_title", "location", F.col("posting_date").cast("string").alias("posting_date"), "job_responsibilities", "min_education", "min_experience", "job_identification")


_KEPT_SQL = "(p_partkey % 11 <> 0 OR p_partkey % 7 IN (2, 5, 6))"
_PAID_SQL = "'$' || p_size || ',000-$' || (p_size + 9) || ',000'"


@query(f"""WITH came AS (SELECT *, p_partkey AS k, p_partkey % 13 <> 0 AS whole FROM part WHERE {_KEPT_SQL}),
stored AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 2 = 0)
SELECT 'u' || coalesce(c.k, s.k) AS job_url, CASE WHEN s.k IS NOT NULL THEN 'Old' ELSE 'C' || c.k % 5 END AS company_name, CASE WHEN c.k IS NULL THEN 'old title' ELSE p_name END AS job_title,
CASE WHEN c.k IS NULL OR c.k % 3 = 1 THEN CASE WHEN c.k IS NULL THEN 'R-old' END ELSE 'R-' || c.k END AS job_identification,
CASE WHEN c.k % 7 = 4 AND whole THEN 'Chips, Tools' END AS job_category,
CASE WHEN whole THEN 'Build ' || p_brand || ' parts' WHEN s.k IS NOT NULL THEN 'old duty' END AS job_responsibilities,
CASE WHEN whole AND (c.k % 7 = 5 OR c.k % 2 = 0) THEN CASE WHEN c.k % 2 = 0 THEN 'Bachelor of ' ELSE 'Knows ' END || p_type WHEN s.k IS NOT NULL THEN 'old education' END AS min_education,
CASE WHEN whole AND c.k % 7 <> 5 AND c.k % 2 = 1 THEN 'Knows ' || p_type END AS min_experience,
CASE WHEN whole THEN {_PAID_SQL} WHEN s.k IS NOT NULL THEN '$1-$2' END AS salary_range
FROM came c FULL JOIN stored s ON c.k = s.k""")
def ingest_platforms(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of all seven platforms into a filled store. Places abroad go where the platform has a rule, pay is in
    each platform's own place, and a page that is missing keeps the details that the store has."""
    k = F.col("p_partkey")
    low, high = _text("$", F.col("p_size"), ",000"), _text("$", F.col("p_size") + 9, ",000")
    #: platform, heading of the duties, of the requirements, and pay before and after them
    kinds = [
        ("boeing", "Position Responsibilities", "Basic Qualifications", F.lit("<p>Bonus $1-$2</p>"), _text("<h3>Summary Pay Range</h3><p>", low, "-", high, "</p>")),
        ("talentbrew", "What You'll Be Doing", "What You'll Need", F.lit("<p>Bonus $1-$2</p>"), _text("<h3>Base Salary Range: ", low, "-", high, "</h3>")),
        ("dayforce", "Responsibilities", "Required Qualifications", _text("<p>Pay ", low, "-", high, "</p>"), F.lit("")),
        ("workday", "Key Responsibilities", "Minimum Qualifications", _text("<p>Pay ", low, "-", high, "</p>"), F.lit("")),
        ("icims", "KEY RESPONSIBILITIES", "MINIMUM QUALIFICATIONS", _text("<p>Pay Range: MIN ", low, " MAX ", high, "</p>"), F.lit("")),
        ("oracle", "Key Responsibilities", "Minimum requirements", _text("<p>Pay ", low, "-", high, "</p>"), F.lit("")),
        ("successfactors", "Key Responsibilities", "Required Qualifications", _text("<p>Pay ", low, "-", high, "</p>"), F.lit("")),
    ]
    by_kind = lambda values: F.get(F.array(*values), (k % 7).cast("int"))
    line = F.when(k % 2 == 0, _text("Bachelor of ", F.col("p_type"))).otherwise(_text("Knows ", F.col("p_type")))
    body = by_kind([_text(before, f"<h2>{duties}</h2><ul><li>Build ", F.col("p_brand"), f" parts</ul><h2>{need}</h2><ul><li>", line, "</ul>", after) for _, duties, need, before, after in kinds])
    job = F.to_json(F.struct(F.struct(body.alias("description"), F.array(F.lit(" Chips"), F.lit("Tools ")).alias("category")).alias("job")))
    body = F.when(k % 7 == 4, _text("<script>window.jobDescriptionConfig = ", job, "; </script>")).otherwise(body)
    nothing = F.struct(F.lit("").alias("q"), F.array().cast("array<string>").alias("states"), (k % 11 != 0).alias("country_facet"))
    rows = spread(table(spark, d, "part")).select(
        by_kind([F.lit(x[0]) for x in kinds]).alias("platform"), _text("C", k % 5).alias("company_name"), _text("u", k).alias("url"), F.col("p_name").alias("title"), F.when(k % 11 == 0, "Paris, France").otherwise("Austin, Texas, United States").alias("location"),
        F.when(k % 13 != 0, body).alias("body"), F.lit("Posted: 01/02/2026").alias("posted"), k.cast("long").alias("ord"), F.when(k % 3 != 1, _text("R-", k)).alias("job_identification"), nothing.alias("filters"), F.lit("2026-03-31").cast("date").alias("as_of"),
    )
    stored = table(spark, d, "part").filter(k % 2 == 0).select(_text("u", k).alias("job_url"), F.lit("Old").alias("company_name"), F.lit("old title").alias("job_title"), F.lit("Old town").alias("location"), F.lit("2025-01-01").cast("date").alias("posting_date"), F.lit("R-old").alias("job_identification"), F.lit("old duty").alias("job_responsibilities"), F.lit("old education").alias("min_education"), F.lit("$1-$2").alias("salary_range"))
    out = ingest(stored, rows)
    return out.select("job_url", "company_name", "job_title", "job_identification", "job_category", "job_responsibilities", "min_education", "min_experience", "salary_range")
