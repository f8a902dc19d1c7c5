"""Queries of the field cascades: postings of several shapes, chosen by key, and what each field has to be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import lines as L
from millrace.operators import cascades as C
from millrace.operators import details as D
from millrace.operators import pulls
from millrace.operators.dayforce import dayforce_details
from millrace.operators.spread import spread
from millrace.plans.sourcing import _text
from millrace.registry import query, table


def _shapes(k: Column, shapes: list[Column]) -> Column:
    return F.get(F.array(*shapes), (k % len(shapes)).cast("int"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Bachelor degree for ' || p_brand || '.' WHEN 1 THEN 'MSEE' WHEN 2 THEN 'Diploma of ' || p_brand WHEN 3 THEN 'Employer will accept a Master of ' || p_brand WHEN 4 THEN 'Degree in ' || p_brand END AS min_education,
CASE p_partkey % 6 WHEN 0 THEN 'Good eyes' WHEN 1 THEN p_size || ' years of design work' WHEN 2 THEN 'Four years' || chr(10) || 'Travel' WHEN 3 THEN 'Two years of ' || p_type WHEN 5 THEN 'Knows ' || p_type END AS min_experience,
CASE p_partkey % 6 WHEN 0 THEN 'Minimum 3 years preferred' || chr(10) || 'Likes ' || p_type WHEN 4 THEN 'Humour' END AS preferred_qualifications,
CASE p_partkey % 6 WHEN 0 THEN 'As a maker of ' || p_brand || ' you will build all of it.' || chr(10) || chr(10) || 'Build ' || p_brand || chr(10) || 'Run it' END AS job_responsibilities,
CASE p_partkey % 6 WHEN 2 THEN 'Leadership: Leads ' || p_brand END AS essential_skills FROM part""")
def workday_fields(spark: SparkSession, d: str) -> DataFrame:
    """Postings without fixed sections, read by the cascade of their platform."""
    brand, kind = F.col("p_brand"), F.col("p_type")
    html = _shapes(F.col("p_partkey"), [
        _text("<p>As a maker of ", brand, " you will build all of it.</p><h3>Key Responsibilities</h3><ul><li>Build ", brand, "<li>Run it</ul><b>Minimum Qualifications:</b><ul><li>Bachelor degree for ", brand, ". Minimum 3 years preferred<li>Good eyes</ul><p><b>Preferred Qualifications</b></p><ul><li>Likes ", kind, "</ul>"),
        _text("<b>Basic Qualifications</b><ul><li>MSEE + ", F.col("p_size"), " years of design work</ul>"),
        _text("<b>Leadership</b><p>Leads ", brand, "</p><b>Education:</b><p>Diploma of ", brand, "</p><b>Experience Required</b><p>Four years</p><b>Other Requirements</b><p>Travel</p>"),
        _text("<p>Employer will accept a Master of ", brand, "</p><p>Position requires:</p><p>1. Two years of ", kind, "</p>"),
        _text("<b>Preferred Skills</b><ul><li>Degree in ", brand, "<li>Humour</ul>"),
        _text("<b>Your Background</b><ul><li>Knows ", kind, "<li>#LI-AB</ul>"),
    ])
    rows = spread(table(spark, d, "part")).select("p_partkey", D.line_records(html).alias("lines"))
    return C.workday_details(rows).select("p_partkey", "min_education", "min_experience", "preferred_qualifications", "job_responsibilities", "essential_skills")


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Bachelor''s degree in ' || p_brand WHEN 2 THEN 'Degree in ' || p_brand WHEN 3 THEN 'Diploma or degree required' END AS min_education,
CASE p_partkey % 4 WHEN 0 THEN 'Years of ' || p_type WHEN 1 THEN 'RTL work on ' || p_type || chr(10) || 'Calm' WHEN 2 THEN 'Must be enrolled in an accredited college' WHEN 3 THEN 'Labs required' END AS min_experience,
CASE p_partkey % 4 WHEN 0 THEN 'Master''s degree in ' || p_brand WHEN 2 THEN 'PhD preferred' || chr(10) || 'Humour' WHEN 3 THEN 'Travel preferred' END AS preferred_qualifications,
CASE WHEN p_partkey % 4 = 0 THEN 'You design ' || p_brand END AS job_responsibilities FROM part""")
def icims_fields(spark: SparkSession, d: str) -> DataFrame:
    """Postings whose fields are routed by which other sections there are."""
    brand, kind = F.col("p_brand"), F.col("p_type")
    html = _shapes(F.col("p_partkey"), [
        _text("<h2>The Role</h2><p>You design ", brand, "</p><h2>Preferred Experience</h2><ul><li>Years of ", kind, "</ul><h2>Academic Credentials</h2><p>Bachelor's or Master's degree (preferred) in ", brand, "</p>"),
        _text("<h2>Preferred Experience</h2><p>RTL work on ", kind, "</p><h2>The Person</h2><p>Calm</p>"),
        _text("<h2>Qualifications</h2><ul><li>Required:<li>Degree in ", brand, "<li>Must be enrolled in an accredited college<li>PhD preferred<li>Desired:<li>Humour</ul>"),
        _text("<h2>Experience</h2><ul><li>Diploma or degree required<li>Labs required<li>Travel preferred</ul>"),
    ])
    rows = spread(table(spark, d, "part")).select("p_partkey", D.line_records(html).alias("lines"))
    return C.icims_details(rows).select("p_partkey", "min_education", "min_experience", "preferred_qualifications", "job_responsibilities")


@query("SELECT p_partkey, p_name || '|more of ' || p_type AS texts FROM part")
def paragraph_section(spark: SparkSession, d: str) -> DataFrame:
    """Plain paragraphs under a paragraph that is a heading and nothing else, up to the next known one."""
    html = _text("<p>Intro</p><p>Education and Skills:</p><p>", F.col("p_name"), "</p><ul><li>more of ", F.col("p_type"), "</li></ul><p>What you should have</p><p>no</p>")
    rows = spread(table(spark, d, "part")).select("p_partkey", D.line_records(html).alias("lines"))
    return rows.select("p_partkey", F.array_join(C.section(F.col("lines"), [r"Education\s+and\s+Skills"]), "|").alias("texts"))


@query("SELECT p_partkey, 'Bachelor in ' || p_brand || '.' AS kept, CASE WHEN p_partkey % 2 = 0 THEN 'A ' || p_type || ' preferred' END AS preferred FROM part")
def preferred_split(spark: SparkSession, d: str) -> DataFrame:
    line = _text("Bachelor in ", F.col("p_brand"), ".", F.when(F.col("p_partkey") % 2 == 0, _text(" A ", F.col("p_type"), " preferred")).otherwise(""))
    parts = L.split_preferred(F.array(line), C.EDUCATION)
    return table(spark, d, "part").select("p_partkey", F.get(parts["kept"], 0).alias("kept"), F.get(parts["preferred"], 0).alias("preferred"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'Summary of ' || p_brand || ' for everyone' || chr(10) || chr(10) END || CASE WHEN p_partkey % 3 = 0 THEN 'Summary of ' || p_brand || ' for everyone and more' ELSE p_type END || chr(10) || chr(10) || 'Build it' AS duties FROM part")
def duty_assembly(spark: SparkSession, d: str) -> DataFrame:
    """A summary that a part already holds is left out."""
    summary = _text("Summary of ", F.col("p_brand"), " for everyone")
    part = F.when(F.col("p_partkey") % 3 == 0, F.concat(summary, F.lit(" and more"))).otherwise(F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", L.assemble(summary, F.array(part, F.lit("Build it"), F.lit(None).cast("string"))).alias("duties"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Bachelor''s degree in ' || p_brand ELSE 'Bachelor of ' || p_type END AS education, CASE WHEN p_partkey % 2 = 0 THEN 'Master''s degree in ' || p_brand END AS preferred FROM part")
def credential_parts(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("p_partkey") % 2 == 0, _text("Bachelor's or Master's degree (preferred) in ", F.col("p_brand"))).otherwise(_text("Bachelor of ", F.col("p_type")))
    return table(spark, d, "part").select("p_partkey", L.split_credentials(text).alias("x")).select("p_partkey", "x.*")


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'As a maker of ' || p_type || ' you build things.' WHEN 1 THEN 'We are looking for people who know ' || p_brand WHEN 2 THEN 'The ' || p_brand || ' team is one of the best there are.' END AS summary FROM part""")
def role_intro(spark: SparkSession, d: str) -> DataFrame:
    """The first line that introduces the role; shorter ones and other lines aren't it."""
    html = _shapes(F.col("p_partkey"), [_text("<p>As a rule.</p><p>As a maker of ", F.col("p_type"), " you build things.</p>"), _text("<p>Hello</p><div>We are looking for people who know ", F.col("p_brand"), "</div>"), _text("<p>The ", F.col("p_brand"), " team is one of the best there are.</p>"), F.lit("<p>Come to us, it is very nice here.</p>")])
    rows = spread(table(spark, d, "part")).select("p_partkey", D.line_records(html).alias("lines"))
    return rows.select("p_partkey", C.role_summary(F.col("lines")).alias("summary"))


@query("""SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'Build ' || p_brand WHEN 1 THEN 'Knows ' || p_type || '|Tools:|Likes ' || p_brand WHEN 2 THEN 'Designs ' || p_brand || '|Really|Runs ' || p_type WHEN 3 THEN 'Last of ' || p_brand WHEN 4 THEN 'Loose ' || p_type WHEN 5 THEN 'all of ' || p_brand END AS lines FROM part""")
def form_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections whose headings and stops have several forms: a titled list, bold labels, bold inside of a heading's
    section, a heading that comes twice, one of another form, one that a line opens with, and none."""
    k, brand, kind = F.col("p_partkey") % 7, F.col("p_brand"), F.col("p_type")
    html = _shapes(F.col("p_partkey"), [
        _text("<p><span>Key Responsibilities</span></p><ul><li>Build ", brand, "</ul><p>Other Things</p><ul><li>no</ul>"),
        _text("<b>Minimum Qualifications</b><ul><li>Knows ", kind, "</ul><b>Tools:</b><ul><li>Likes ", brand, "</ul><b>Total Rewards</b><p>much of it</p>"),
        _text("<h2>The Role</h2><p>Designs ", brand, "</p><b>Really</b><p>Runs ", kind, "</p><h2>The Person</h2><p>no</p>"),
        _text("<p>Minimum Qualifications: they are needed.</p><b>Minimum Qualifications</b><ul><li>Last of ", brand, "</ul>"),
        _text("<h4>The Role</h4><p>Loose ", kind, "</p><p>AMD is committed to it</p><p>no</p>"),
        _text("<p><b>Key Responsibilities:</b> all of ", brand, "</p><p><b>Pay:</b> much</p>"),
        _text("<p>The role has key responsibilities for ", brand, "</p>"),
    ])
    groups = {"sf": (D.RESPONSIBILITIES["successfactors"], D.SF_RULES), "workday": (C.NEEDED, C.WORKDAY_LABELLED), "icims": ([r"The\s+Role"], C.ICIMS_RULES)}
    found = spread(table(spark, d, "part")).select("p_partkey", k.alias("k"), D.located_sections(D.line_records(html), groups).alias("f"))
    one = F.when(F.col("k").isin(1, 3), F.col("f.workday")).when(F.col("k").isin(2, 4), F.col("f.icims")).otherwise(F.col("f.sf"))
    return found.select("p_partkey", L.joined(one, "|").alias("lines"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 4 THEN NULL ELSE 'Build ' || p_brand || chr(10) || 'Run it' END AS job_responsibilities,
CASE p_partkey % 5 WHEN 0 THEN 'Diploma of ' || p_type WHEN 1 THEN 'BS in ' || p_brand WHEN 2 THEN 'Degree of ' || p_brand END AS min_education,
CASE p_partkey % 5 WHEN 0 THEN 'Knows ' || p_brand || chr(10) || 'BS in ' || p_brand WHEN 1 THEN 'Knows ' || p_type WHEN 2 THEN p_size || ' years' WHEN 3 THEN 'Knows ' || p_brand END AS min_experience,
CASE p_partkey % 5 WHEN 2 THEN 'Likes ' || p_type END AS preferred_qualifications FROM part""")
def dayforce_fields(spark: SparkSession, d: str) -> DataFrame:
    """Postings whose headings are plain lines: a label before a degree, a degree, sections of their own, no degree,
    and no heading; of a section that comes twice the last counts."""
    brand, kind = F.col("p_brand"), F.col("p_type")
    duties = _text("<p>About us</p><div>Responsibilities:</div><ul><li>Build ", brand, "<li>Run it</ul>")
    html = _shapes(F.col("p_partkey"), [
        F.concat(duties, _text("<p>Required Qualifications</p><p>&bull; Knows ", brand, "</p><p>&bull; BS in ", brand, "</p><p>- Education:  Diploma of ", kind, "</p>")),
        F.concat(duties, _text("<p>REQUIRED QUALIFICATION</p><ul><li>Knows ", kind, "<li>BS in ", brand, "</ul><p>US Citizenship Required</p>")),
        F.concat(duties, _text("<p>Education</p><p>none</p><p>Experience and Skills:</p><p>", F.col("p_size"), " years</p><p>Education</p><p>Degree of ", brand, "</p><p>Required Qualifications</p><p>BS, no</p><p>Preferred Qualifications</p><p>Likes ", kind, "</p>")),
        F.concat(duties, _text("<p>Required Qualifications:</p><p>Knows ", brand, "</p>")),
        _text("<p>Education is what ", brand, " needs</p>"),
    ])
    rows = spread(table(spark, d, "part")).select("p_partkey", D.rendered_lines(html).alias("lines"))
    return dayforce_details(rows).drop("lines")


def _replayed(members: list[dict], attempt: int) -> list[tuple]:
    """The captured answer to one try: a batch whose answer is an error page has failed."""
    if any(m["fails"] >= attempt for m in members):
        raise ValueError(f"error page for {members[0]['n_nationkey']}")
    return [(m["s_suppkey"], m["n_name"]) for m in members]


@query("""WITH m AS (SELECT s_suppkey, n_nationkey, n_name, CASE WHEN s_suppkey % 31 = 0 THEN 9 WHEN s_suppkey % 7 = 0 THEN 2 ELSE 0 END AS fails, (row_number() OVER (ORDER BY n_nationkey, s_suppkey) - 1) // 5 + 1 AS batch FROM supplier JOIN nation ON s_nationkey = n_nationkey),
b AS (SELECT batch, max(fails) AS f, count(*) AS n, first(n_nationkey ORDER BY n_nationkey, s_suppkey) AS k FROM m GROUP BY 1)
SELECT batch, CAST(CASE WHEN f >= 3 THEN 3 ELSE f + 1 END AS INTEGER) AS attempts, CASE WHEN f >= 3 THEN 'ValueError: error page for ' || k END AS error, CAST(CASE WHEN f >= 3 THEN 0 ELSE n END AS INTEGER) AS n_rows FROM b""")
def pull_report(spark: SparkSession, d: str) -> DataFrame:
    """Batches of five members, tried up to three times: how often, and which never came."""
    return pulls.report(_pulled(spark, d))


@query("""WITH m AS (SELECT s_suppkey, n_nationkey, n_name, CASE WHEN s_suppkey % 31 = 0 THEN 9 WHEN s_suppkey % 7 = 0 THEN 2 ELSE 0 END AS fails, (row_number() OVER (ORDER BY n_nationkey, s_suppkey) - 1) // 5 + 1 AS batch FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT batch, CAST(s_suppkey AS BIGINT) AS member, n_name AS answer FROM m WHERE batch NOT IN (SELECT batch FROM m WHERE fails >= 3)""")
def pull_batches(spark: SparkSession, d: str) -> DataFrame:
    """The rows of all batches that came; those that failed for good take no other with them."""
    return pulls.pulled_rows(_pulled(spark, d))


def _pulled(spark: SparkSession, d: str) -> DataFrame:
    fails = F.when(F.col("s_suppkey") % 31 == 0, 9).when(F.col("s_suppkey") % 7 == 0, 2).otherwise(0)
    members = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_nationkey", "n_name", fails.alias("fails"))
    return pulls.pull(pulls.in_batches(members, ["n_nationkey", "s_suppkey"], 5), _replayed, "member bigint, answer string")
