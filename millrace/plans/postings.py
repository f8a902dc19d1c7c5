"""Store queries: views, upserts, runs, latest exports and the documented reports.

Orders stand for postings and customers for companies; events are a change log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import slug
from millrace.operators.kept import Store
from millrace.operators.sequences import probed, side_by_side, with_ordinal
from millrace.operators.store import evolve, finish_run, first_by, fold_batch, insert_absent, least_by, upsert, upsert_counts
from millrace.registry import query, table
from millrace.sources.captured import EXPORT
from millrace.sources.workspace import workspace


@query("SELECT o_orderkey, c_name, o_orderstatus, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def view_inner(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_orderstatus", "o_totalprice")


@query("""SELECT event_id AS run_id, c_name AS company_name, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2020-01-01') AS DOUBLE) / 1000000 AS duration_seconds
FROM events LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON user_id = c_custkey""")
def run_stats(spark: SparkSession, d: str) -> DataFrame:
    """Runs with their company; runs without one stay."""
    companies = table(spark, d, "customer").filter("c_custkey % 2 = 0")
    runs = table(spark, d, "events").join(companies, F.col("user_id") == F.col("c_custkey"), "left")
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit("2020-01-01 00:00:00").cast("timestamp"))).cast("double") / 1_000_000
    return runs.select(F.col("event_id").alias("run_id"), F.col("c_name").alias("company_name"), F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"), seconds.alias("duration_seconds"))


@query("SELECT c_name AS company_name, CAST(count(*) AS BIGINT) AS jobs FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def jobs_by_company(spark: SparkSession, d: str) -> DataFrame:
    """Counted by key before the names are joined."""
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("jobs"))
    return n.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_name").alias("company_name")).agg(F.sum("jobs").alias("jobs")).orderBy(F.desc("jobs"), "company_name")


@query("SELECT n_name AS location, CAST(count(*) AS BIGINT) AS jobs FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY jobs DESC, location LIMIT 10")
def top_locations(spark: SparkSession, d: str) -> DataFrame:
    """A top-10 report; the limit is the feature."""
    n = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.count("*").alias("jobs"))
    return n.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("location"), "jobs").orderBy(F.desc("jobs"), "location").limit(10)


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS posting_date FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-07-01' - INTERVAL 30 DAY AND CAST(o_orderdate AS DATE) <= DATE '1998-07-01'")
def recent_postings(spark: SparkSession, d: str) -> DataFrame:
    as_of = F.lit("1998-07-01").cast("date")
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("posting_date"))
    return rows.filter(F.col("posting_date").between(F.date_sub(as_of, 30), as_of)).orderBy(F.desc("posting_date"), "o_orderkey").withColumn("posting_date", F.col("posting_date").cast("string"))


@query("""SELECT CASE WHEN p_type ILIKE '%brass%' THEN 'PhD' WHEN p_type ILIKE '%steel%' OR p_type ILIKE '%tin%' THEN 'Master' WHEN p_type ILIKE '%standard%' THEN 'Bachelor' ELSE 'Other' END AS level, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1""")
def education_level(spark: SparkSession, d: str) -> DataFrame:
    """The first branch that fits names the level."""
    t = F.col("p_type")
    level = F.when(t.ilike("%brass%"), "PhD").when(t.ilike("%steel%") | t.ilike("%tin%"), "Master").when(t.ilike("%standard%"), "Bachelor").otherwise("Other")
    return table(spark, d, "part").groupBy(level.alias("level")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_insert(spark: SparkSession, d: str) -> DataFrame:
    return insert_absent(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), table(spark, d, "customer"), "c_custkey").select("c_custkey", "c_name")


@query("SELECT n_name FROM nation EXCEPT SELECT n_name FROM nation WHERE n_regionkey = 1")
def set_except(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation")
    return nation.select("n_name").subtract(nation.filter("n_regionkey = 1").select("n_name"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1")
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return least_by(rows, ["o_custkey"], [-F.unix_micros(F.col("o_orderdate").cast("timestamp")), F.col("o_orderkey")]).drop("o_orderdate")


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) = 1")
def first_per_key(spark: SparkSession, d: str) -> DataFrame:
    return least_by(table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber"), ["l_partkey"], [F.col("l_orderkey"), F.col("l_linenumber")])


_BATCH_SQL = "batch AS (SELECT user_id AS k, event_id AS ord, CASE WHEN event_id % 3 <> 0 THEN event_type END AS category, CASE WHEN event_id % 4 <> 0 THEN value END AS salary FROM events), target AS (SELECT c_custkey AS k, c_mktsegment AS category, c_acctbal AS salary, CAST(c_nationkey AS INTEGER) AS company FROM customer WHERE c_custkey % 2 = 0)"


def _change_log(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    batch = table(spark, d, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("ord"), F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("category"), F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("salary"))
    target = table(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("category"), F.col("c_acctbal").alias("salary"), F.col("c_nationkey").cast("int").alias("company"))
    return target, batch


@query(f"""WITH {_BATCH_SQL}, fold AS (SELECT k, arg_max_null(category, ord) AS category, arg_max(salary, ord) AS salary FROM batch GROUP BY k)
SELECT coalesce(t.k, f.k) AS k, CASE WHEN f.k IS NOT NULL THEN f.category ELSE t.category END AS category, coalesce(f.salary, t.salary) AS salary,
CAST(CASE WHEN t.k IS NOT NULL THEN t.company ELSE -1 END AS INTEGER) AS company FROM target t FULL JOIN fold f ON t.k = f.k""")
def upsert_fold(spark: SparkSession, d: str) -> DataFrame:
    target, batch = _change_log(spark, d)
    return upsert(target, batch, "k", "ord", ["category"], ["salary"], {"company": F.lit(-1)})


@query(f"""WITH {_BATCH_SQL}, b AS (SELECT k, count(*) AS n FROM batch GROUP BY k), m AS (SELECT b.*, t.k IS NULL AS is_new FROM b LEFT JOIN target t ON b.k = t.k)
SELECT CAST(count(*) FILTER (is_new) AS BIGINT) AS new, CAST(sum(n) - count(*) FILTER (is_new) AS BIGINT) AS updated FROM m""")
def upsert_count(spark: SparkSession, d: str) -> DataFrame:
    target, batch = _change_log(spark, d)
    return upsert_counts(target, batch, "k")


@query(f"WITH {_BATCH_SQL} SELECT k, arg_max_null(category, ord) AS category, arg_max(salary, ord) AS salary, CAST(count(*) AS BIGINT) AS batch_rows FROM batch GROUP BY k")
def batch_fold(spark: SparkSession, d: str) -> DataFrame:
    return fold_batch(_change_log(spark, d)[1], "k", "ord", ["category"], ["salary"])


@query("SELECT s_suppkey, NULL::VARCHAR AS degree_level, NULL::DOUBLE AS pay FROM supplier")
def schema_evolve(spark: SparkSession, d: str) -> DataFrame:
    return evolve(table(spark, d, "supplier").select("s_suppkey"), {"s_suppkey": "long", "degree_level": "string", "pay": "double"})


@query("SELECT s_suppkey, NULL::VARCHAR AS salary_range, NULL::VARCHAR AS min_education FROM supplier")
def null_projection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", *[F.lit(None).cast("string").alias(c) for c in ("salary_range", "min_education")])


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, 'none') AS v FROM orders")
def coalesce_cols(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(k, F.coalesce(F.when(k % 2 == 0, F.col("o_orderstatus")), F.when(k % 3 == 0, F.col("o_orderpriority")), F.lit("none")).alias("v"))


@query("SELECT event_id AS run_id, CASE WHEN event_id % 3 = 0 THEN 'failed' WHEN event_id = 1 THEN 'completed' ELSE 'running' END AS status, CASE WHEN event_id % 3 = 0 THEN 'boom' END AS error_message, CAST(CASE WHEN event_id = 1 THEN 7 ELSE 0 END AS INTEGER) AS jobs_found FROM events")
def run_completion(spark: SparkSession, d: str) -> DataFrame:
    """Run 1 is closed; run 3, which has failed, is not."""
    failed = F.col("event_id") % 3 == 0
    runs = table(spark, d, "events").select(F.col("event_id").alias("run_id"), F.when(failed, "failed").otherwise("running").alias("status"), F.when(failed, "boom").alias("error_message"), *[F.lit(0).alias(c) for c in ("jobs_found", "jobs_new", "jobs_updated")])
    return finish_run(finish_run(runs, 1, 7, 3, 4), 3, 9, 9, 0).select("run_id", "status", "error_message", "jobs_found")


@query("""WITH f AS (SELECT s_suppkey, 'jobs_' || lower(replace(s_name, '#', '_')) || '_' || CAST(20260000 + s_suppkey % 300 AS VARCHAR) || CASE WHEN s_suppkey % 4 = 0 THEN '_v2' ELSE '' END || '.csv' AS file FROM supplier),
p AS (SELECT *, regexp_extract(file, '^jobs_(.+)_([0-9]{8})[^.]*\\.csv$', 1) AS slug, regexp_extract(file, '^jobs_(.+)_([0-9]{8})[^.]*\\.csv$', 2) AS day FROM f)
SELECT slug, file, day FROM p WHERE file NOT LIKE 'jobs\\_all\\_companies\\_%' ESCAPE '\\' QUALIFY row_number() OVER (PARTITION BY slug ORDER BY day DESC, file) = 1""".replace("\\\\", "\\"))
def file_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The latest export of each company, from file names."""
    s = table(spark, d, "supplier")
    file = F.concat(F.lit("jobs_"), F.lower(F.replace("s_name", F.lit("#"), F.lit("_"))), F.lit("_"), (F.col("s_suppkey") % 300 + 20260000).cast("string"), F.when(F.col("s_suppkey") % 4 == 0, "_v2").otherwise(""), F.lit(".csv"))
    pattern = EXPORT
    rows = s.select(file.alias("file")).filter(~F.col("file").startswith("jobs_all_companies_")).select(F.regexp_extract("file", pattern, 1).alias("slug"), "file", F.regexp_extract("file", pattern, 2).alias("day"))
    return first_by(rows, ["slug"], F.desc("day"), F.col("file"))


@query("""SELECT 'jobs_' || trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g'), '_') || '_19980701.csv' AS file, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS closed
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name""")
def export_frame(spark: SparkSession, d: str) -> DataFrame:
    """The rows of each company's dated export; a company without rows has none."""
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    n = rows.groupBy("c_name").agg(F.count("*").alias("n_rows"), F.count_if(F.col("o_orderstatus") == "F").alias("closed"))
    return n.select(F.concat(F.lit("jobs_"), slug(F.col("c_name")), F.lit("_19980701.csv")).alias("file"), "n_rows", "closed")


_PROBE = """WITH h AS (SELECT DISTINCT CAST(({id} - ({first})) / {step} AS BIGINT) AS slot FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND {id} BETWEEN {first} AND {last} AND ({id} - ({first})) % {step} = 0),
g AS (SELECT slot, slot - coalesce(lag(slot) OVER (ORDER BY slot), {before}) AS gap FROM h), s AS (SELECT min(slot) AS stop FROM g WHERE gap > {misses})
SELECT slot * {step} + ({first}) AS id FROM g, s WHERE stop IS NULL OR slot < stop"""


def _open_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))


@query(_PROBE.format(id="o_orderkey", first=-5000, last=1 << 40, step=1, misses=60, before="NULL"))
def id_probe_gap_stop(spark: SparkSession, d: str) -> DataFrame:
    """A probe that starts far below the first hit, which doesn't count, and stops at the first 60 misses after it."""
    return probed(_open_ids(spark, d), "id", -5000, 1 << 40, 1, misses=60)


@query(_PROBE.format(id="o_orderkey", first=3, last=1 << 40, step=4, misses=25, before="-1"))
def id_probe_by_step(spark: SparkSession, d: str) -> DataFrame:
    """Every fourth id from 3 on, where misses count from the start."""
    return probed(_open_ids(spark, d), "id", 3, 1 << 40, 4, misses=25, after_first_hit=False)


@query("SELECT n_nationkey, CAST(ceil(row_number() OVER (ORDER BY n_nationkey) / 5.0) AS BIGINT) AS batch FROM nation")
def batch_bucketing(spark: SparkSession, d: str) -> DataFrame:
    """Institutions in batches of five; the list is a small dimension."""
    return table(spark, d, "nation").select("n_nationkey", F.ceil(F.row_number().over(Window.orderBy("n_nationkey")) / 5).alias("batch"))


@query("SELECT o_orderkey, CAST(o_orderkey % 80 AS BIGINT) AS page_no FROM orders WHERE o_orderkey % 80 <= 50")
def page_cap(spark: SparkSession, d: str) -> DataFrame:
    """A source's own page limit; it is the feature."""
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 80).alias("page_no")).filter("page_no <= 50")


@query("""WITH l AS (SELECT s_name AS title, row_number() OVER (ORDER BY s_suppkey) AS k FROM supplier), n AS (SELECT count(*) AS n FROM supplier),
d AS (SELECT p_name AS duties, p_retailprice AS pay, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS k FROM part)
SELECT CAST(l.k - 1 AS BIGINT) AS ordinal, title, duties, pay FROM l JOIN d ON l.k = d.k""")
def zip_join(spark: SparkSession, d: str) -> DataFrame:
    """A listing beside its details, which share no column: suppliers in order of their numbers, and as many of the
    dearest parts (the length of the listing is what was asked for)."""
    listing = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("title"))
    parts = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("duties"), F.col("p_retailprice").alias("pay"), (-F.col("p_retailprice")).alias("minus"))
    n = min(listing.count(), parts.count())
    dearest = with_ordinal(parts, ["minus", "p_partkey"], "rank").filter(F.col("rank") < n)
    listed = with_ordinal(listing, ["s_suppkey"], "listed").filter(F.col("listed") < n)
    return side_by_side(listed, dearest, ["s_suppkey"], ["rank"]).select("ordinal", "title", "duties", "pay")


_BATCHES = """WITH a AS (SELECT 'https://x.example/' || c_custkey AS job_url, c_mktsegment AS job_title, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS duties, 'n' || c_nationkey AS company_name FROM customer),
b AS (SELECT 'https://x.example/' || (user_id + CASE WHEN event_type = 'view' THEN 100000000 ELSE 0 END) AS job_url, event_id AS ord, CASE WHEN event_id % 3 <> 0 THEN event_type END AS job_title, CASE WHEN event_id % 5 = 0 THEN 'duty ' || event_id END AS duties, 'e' || (event_id % 7) AS company_name FROM events WHERE event_type <> 'click'),
f AS (SELECT job_url, arg_max_null(job_title, ord) AS job_title, max_by(duties, ord) FILTER (duties IS NOT NULL) AS duties, min_by(company_name, ord) AS company_name FROM b GROUP BY 1)
SELECT coalesce(a.job_url, f.job_url) AS job_url, CASE WHEN f.job_url IS NULL THEN a.job_title ELSE f.job_title END AS job_title, coalesce(f.duties, a.duties) AS duties, coalesce(a.company_name, f.company_name) AS company_name,
CAST(CASE WHEN f.job_url IS NULL THEN 1 ELSE 2 END AS BIGINT) AS run_id, CASE WHEN a.job_url IS NULL THEN '2026-01-02' ELSE '2026-01-01' END AS created_on, CASE WHEN f.job_url IS NULL THEN '2026-01-01' ELSE '2026-01-02' END AS updated_on FROM a FULL JOIN f ON a.job_url = f.job_url"""


@query(_BATCHES)
def store_on_disk(spark: SparkSession, d: str) -> DataFrame:
    """Two batches into a store on disk: postings (customers) that come again in events, several times in a batch, with
    and without values, postings that don't, and new ones (those that were viewed)."""
    store = Store(spark, workspace(spark, "store"), "job_url string, job_title string, duties string, company_name string", "job_url", ["job_title"], ["duties"], buckets=16)
    c, e = table(spark, d, "customer"), table(spark, d, "events").filter("event_type <> 'click'")
    named = lambda text, k: F.concat(F.lit(text), k.cast("string"))
    url, k = "https://x.example/", F.col("event_id")
    store.apply(c.select(named(url, F.col("c_custkey")).alias("job_url"), F.col("c_custkey").alias("ord"), F.col("c_mktsegment").alias("job_title"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("duties"), named("n", F.col("c_nationkey")).alias("company_name")), "ord", 1, "2026-01-01 00:00:00")
    key = F.col("user_id") + F.when(F.col("event_type") == "view", 100_000_000).otherwise(0)
    store.apply(e.select(named(url, key).alias("job_url"), k.alias("ord"), F.when(k % 3 != 0, F.col("event_type")).alias("job_title"), F.when(k % 5 == 0, named("duty ", k)).alias("duties"), named("e", k % 7).alias("company_name")), "ord", 2, "2026-01-02 00:00:00")
    day = lambda x: F.col(x).cast("date").cast("string")
    return store.read().select("job_url", "job_title", "duties", "company_name", "run_id", day("created_at").alias("created_on"), day("updated_at").alias("updated_on"))
