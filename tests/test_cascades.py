"""Field cascades over postings of several shapes, and the pieces they are made of."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import lines as L
from millrace.functions import scalars as S
from millrace.operators import cascades as C
from millrace.operators import details as D

LEAST = "Bachelor degree in physics"
WORKDAY = {
    "own section": ("<p>As a tester you will look at all of our chips, every day.</p><h3>Key Responsibilities</h3><ul><li>Test chips<li>Write it down</ul><b>Minimum Qualifications:</b><ul><li>Bachelor degree in physics. Minimum 3 years in labs preferred (asset).<li>Fraud alert: Micron never asks<li>Good eyes</ul><p><b>Preferred Qualifications</b></p><ul><li>Likes dust</ul>", LEAST + ".", "Good eyes", "Minimum 3 years in labs preferred (asset).\nLikes dust"),
    "degree and years": ("<b>Basic Qualifications</b><ul><li>MSEE + 5 years of design work<li>Tools</ul>", "MSEE", "5 years of design work\nTools", None),
    "education and skills": (f"<p>Education and Skills:</p><p>{LEAST}</p><p>Knows a good many tools by name</p><p>Experience:</p><p>4 years in a fab</p>", LEAST, "4 years in a fab", None),
    "combined": (f"<b>Qualifications</b><ul><li>{LEAST}<li>2 years #LI-XX1<li>#LI-AB</ul>", LEAST, "2 years", None),
    "no degree": ("<b>Your Background</b><ul><li>Knows things<li>And more</ul>", None, "Knows things\nAnd more", None),
    "single headings": ("<b>Education:</b><p>Diploma of some kind</p><b>Experience Required</b><p>Ten years</p><b>Other Requirements</b><p>Travel</p>", "Diploma of some kind", "Ten years\nTravel", None),
    "in one": (f"<b>Experience and Education</b><ul><li>Six years<li>{LEAST}</ul>", LEAST, "Six years", None),
    "filing": ("<p>Employer will accept a Master degree in EE.</p><p>Position requires:</p><p>1. Two years of VHDL</p><p>2. Patience</p>", "Employer will accept a Master degree in EE.", "Two years of VHDL\nPatience", None),
    "filing with minimum": ("<p>Minimum Bachelor degree in CS, and 5 years of experience with C.</p>", "Bachelor degree in CS", "5 years of experience with C.", None),
    "only preferred": (f"<b>Preferred Skills</b><ul><li>{LEAST}<li>Humour</ul>", LEAST, None, "Humour"),
    "nothing": ("<p>Come to us.</p>", None, None, None),
    "null": (None, None, None, None),
}


@pytest.fixture(scope="module")
def rows(spark):
    def run(shapes, cascade):
        df = spark.createDataFrame([(k, v[0]) for k, v in shapes.items()], "name string, html string").withColumns({"s": F.lit(1), "lines": D.line_records("html")})
        return {r.name: r for r in cascade(df).collect()}

    return run


def test_workday_shapes(rows):
    got = rows(WORKDAY, C.workday_details)
    assert {k: (r.min_education, r.min_experience, r.preferred_qualifications) for k, r in got.items()} == {k: v[1:] for k, v in WORKDAY.items()}
    assert got["own section"].job_responsibilities == "As a tester you will look at all of our chips, every day.\n\nTest chips\nWrite it down"
    assert got["education and skills"].job_responsibilities == "Knows a good many tools by name" and got["null"].s == 1


def test_workday_skills(rows):
    html = "<p>Impact</p><p>not marked</p><b>Leadership</b><p>Leads a team</p><b>Problem Solving:</b><ul><li>Solves<li>Asks</ul>"
    assert rows({"x": (html,)}, C.workday_details)["x"].essential_skills == "Leadership: Leads a team\nProblem Solving: Solves Asks"


ICIMS = {
    "preferred degree": ("<h2>The Role</h2><p>You design.</p><h2>Preferred Experience</h2><ul><li>5 years of RTL</ul><h2>Academic Credentials</h2><p>Bachelor's or Master's degree (preferred) in EE</p>", "Bachelor's degree in EE", "5 years of RTL", "Master's degree in EE"),
    "no other requirement": ("<h2>Preferred Experience</h2><p>RTL work</p>", None, "RTL work", None),
    "both preferred": ("<h2>Preferred Experience</h2><p>RTL work</p><h2>Preferred Qualifications</h2><p>Humour</p>", None, None, "RTL work\nHumour"),
    "ideal": ("<h2>The Role</h2><p>You design. The ideal candidate will have many years of work in labs. Yes.</p><h2>The Person</h2><p>Calm</p>", None, "The ideal candidate will have many years of work in labs.\nCalm", None),
    "split": (f"<h2>Minimum Qualifications</h2><ul><li>{LEAST}<li>MS Office</ul>", LEAST, "MS Office", None),
    "labels": (f"<h2>Qualifications</h2><ul><li>Required:<li>{LEAST}<li>Must be enrolled in an accredited college<li>PhD preferred<li>Desired:<li>Humour</ul>", LEAST, "Must be enrolled in an accredited college", "PhD preferred\nHumour"),
    "experience": (f"<h2>Experience</h2><ul><li>{LEAST} required<li>Labs required<li>Travel preferred</ul>", f"{LEAST} required", "Labs required", "Travel preferred"),
    "null": (None, None, None, None),
}


def test_icims_shapes(rows):
    got = rows(ICIMS, C.icims_details)
    assert {k: (r.min_education, r.min_experience, r.preferred_qualifications) for k, r in got.items()} == {k: v[1:] for k, v in ICIMS.items()}
    assert got["preferred degree"].job_responsibilities == "You design."


def test_assembly_and_lines(spark):
    df = spark.createDataFrame([("sum of it, which is long enough", ["a part", "sum of it, which is long enough and on", None]), (None, ["x", "a line over twenty characters", "a line over twenty characters", "x"]), ("only", []), (None, [])], "s string, p array<string>")
    assert [r[0] for r in df.select(L.assemble(F.col("s"), F.col("p"))).collect()] == ["a part\n\nsum of it, which is long enough and on", "x\n\na line over twenty characters\n\n\nx", "only", None]
    assert spark.range(1).select(L.dedup_lines(F.array(*map(F.lit, ["ab", "ab", "x" * 21, "x" * 21])))).first()[0] == ["ab", "ab", "x" * 21]


@pytest.mark.parametrize(("least", "most", "html", "pay"), [("USD $126,640.00/Yr.", "USD $189,960.00/Yr.", None, "$126,640-$189,960"), (None, "x", "<p>Colorado pay range: MIN $89,600- MAX $149,330</p>", "$89,600-$149,330"), (None, None, "pay range MIN $5", "$5+"), (None, None, "Pay Range: USD $55,680.00 - USD $92,800.00 Year", "$55,680.00-$92,800.00"), (None, None, "Pay Range: $20 Hourly-$30 Hourly", "$20-$30/hr"), (None, None, "none", None)])
def test_icims_pay(spark, least, most, html, pay):
    assert spark.createDataFrame([(least, most, html)], "a string, b string, c string").select(S.icims_pay(F.col("a"), F.col("b"), F.col("c"))).first()[0] == pay


def test_labelled_pay(spark):
    df = spark.createDataFrame([(["x $1-$2", "Base Salary Range $10-$20"], "$3-$4"), (["base salary range: ask"], "$3-$4"), (["x"], "Rewards $3-$4"), ([], None)], "l array<string>, o string")
    assert [r[0] for r in df.select(S.labelled_pay(F.col("l"), "Base Salary Range", F.col("o"))).collect()] == ["$10-$20", None, "$3-$4", None]


def test_url_rules(spark):
    df = spark.createDataFrame([("https://jobs.dayforcehcm.com/en-US/SkyWater/CANDIDATE/x",), ("https://jobs.dayforcehcm.com/Solo/",), ("https://a.b/x?q=Texas+Inst%26&facet_fam=a,b&states=Ohio,Iowa#f",), ("https://a.b/x",)], "u string")
    got = df.select(S.dayforce_namespace(F.col("u")).alias("n"), S.listing_filters(F.col("u")).alias("f")).collect()
    assert [r.n for r in got] == ["skywater", "solo", None, None]
    assert (got[2].f.q, got[2].f.facets, got[2].f.states) == ("Texas Inst&", {"fam": ["a", "b"]}, ["Ohio", "Iowa"]) and (got[3].f.q, got[3].f.facets, got[3].f.states) == ("", {}, [])
