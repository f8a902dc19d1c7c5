"""Sections by the form of their headings, on golden pages of each wrapper, and summaries."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.forms import Rules, intro_of, section_of
from millrace.functions.htmltext import render
from millrace.operators import cascades as C
from millrace.operators import details as D

SF = {
    "heading tag": ("<h3><b>Key Responsibilities</b></h3><ul><li>Build<li>Run</ul><h2>Benefits</h2><ul><li>no</ul>", ["Build", "Run"]),
    "bold with spans": ("<b><span><span>Key Responsibilities:</span></span></b><ul><li>Build</ul><strong>Benefits</strong><p>none of it</p>", ["Build"]),
    "paragraph of spans": ("<p><span><span>Key Responsibilities</span></span></p><ul><li>Build</ul><p><span>Other Things</span></p><ul><li>no</ul>", ["Build"]),
    "heading tag before bold": ("<b>Key Responsibilities</b><p>only told about</p><h2>Key Responsibilities</h2><p>Build it all</p>", ["Build it all"]),
    "list items before paragraphs": ("<h2>Key Responsibilities</h2><p>You will do this:</p><ul><li>Build</ul>", ["Build"]),
    "short paragraphs": ("<h2>Key Responsibilities</h2><p>abc</p><p>abcd</p>", ["abcd"]),
    "lead": ("<p><b>Key Responsibilities:</b> build all of it</p><p><b>Pay:</b> much</p>", ["build all of it"]),
    "empty, then a later place": ("<h2>Key Responsibilities</h2><h2>Key Responsibilities</h2><p>Build it all</p>", ["Build it all"]),
    "nothing": ("<p>We have key responsibilities for you.</p>", None),
}


@pytest.mark.parametrize("name", SF)
def test_successfactors_forms(name):
    assert section_of(render(SF[name][0]), D.RESPONSIBILITIES["successfactors"], D.SF_RULES) == SF[name][1]


WORKDAY = {
    "last place": ("<p>Minimum Qualifications: are required to be considered.</p><b>Minimum Qualifications</b><ul><li>A degree</ul>", C.WORKDAY_LABELLED, ["A degree"]),
    "last place is empty": ("<b>Minimum Qualifications</b><ul><li>A degree</ul><p>Minimum Qualifications</p>", C.WORKDAY_LABELLED, ["A degree"]),
    "labels inside": ("<b>Minimum Qualifications</b><ul><li>A degree</ul><b>Technical expertise:</b><ul><li>Tools</ul><b>Total Rewards</b><p>much of it</p>", C.WORKDAY_LABELLED, ["A degree", "Technical expertise:", "Tools"]),
    "labels end": ("<b>Minimum Qualifications</b><ul><li>A degree</ul><b>Technical expertise:</b><ul><li>Tools</ul>", C.WORKDAY_RULES, ["A degree"]),
    "split words": ("<b><span>Minimum</span><span> Qualifications:</span></b><ul><li>A degree</ul>", C.WORKDAY_RULES, ["A degree"]),
    "no-break space": ("<b>Minimum&nbsp;Qualifications</b>&nbsp;<p>A degree of some kind</p><p>What We Offer:</p><p>much of it</p>", C.WORKDAY_RULES, ["A degree of some kind"]),
    "bold in a list": ("<b>Minimum Qualifications</b><ul><li><b>Degree</b> in physics<li>Eyes</ul>", C.WORKDAY_RULES, ["Degree in physics", "Eyes"]),
}


@pytest.mark.parametrize("name", WORKDAY)
def test_workday_forms(name):
    html, rules, wanted = WORKDAY[name]
    assert section_of(render(html), C.NEEDED, rules) == wanted


ICIMS = {
    "h2 holds bold": ("<h2>The Role</h2><p>You design.</p><p><strong>Really</strong></p><p>You do.</p><h2>The Person</h2><p>Calm</p>", ["You design.", "Really", "You do."]),
    "h3 ends at h2": ("<h3>The Role</h3><p>You design.</p><h2>The Person</h2><p>Calm</p>", ["You design."]),
    "bold ends at bold": ("<strong><u><span>THE ROLE:</span></u></strong><p>You design.</p><b>Extras</b><p>none</p>", ["You design."]),
    "bold ends at a known paragraph": ("<b>The Role</b><p>You design.</p><p>THE PERSON:</p><p>Calm</p>", ["You design."]),
    "paragraph goes over bold": ("<p>THE ROLE:</p><p>You design.</p><p><b>Really</b></p><p>LOCATION:</p><p>Austin</p>", ["You design.", "Really"]),
    "fragments of a word": ("<p><span>T</span><span>HE ROLE:</span></p><p>You design.</p>", ["You design."]),
    "notices": ("<h2>The Role</h2><ul><li>You design.<li>Benefits offered are described: here</ul><p>You do.</p>", ["You design.", "You do."]),
    "other forms are loose": ("<h4>The Role</h4><p>You design.</p><p>AMD is committed to it</p><p>You do.</p>", ["You design."]),
    "breaks": ("<h2>The Role</h2><p>You design.<br>You do.<br>x</p>", ["You design.", "You do."]),
    "in a sentence": ("<p>The role is a good one.</p>", None),
}


@pytest.mark.parametrize("name", ICIMS)
def test_icims_forms(name):
    assert section_of(render(ICIMS[name][0]), [r"The\s+Role"], C.ICIMS_RULES) == ICIMS[name][1]


def test_the_nearest_stop_ends_a_section():
    lines = render("<h2>Duties</h2><p>one of them</p><p>Titled</p><ul><li>two of them</ul><h3>End</h3><p>three of them</p>")
    for stops, wanted in ((("titled list",), ["one of them"]), (("h3",), ["one of them", "Titled", "two of them"]), (("h3", "titled list"), ["one of them"]), (("known",), ["one of them", "Titled", "two of them", "End", "three of them"])):
        assert section_of(lines, ["Duties"], Rules(), stops) == wanted
    assert section_of([], ["Duties"], Rules()) is None and section_of(lines, [], Rules()) is None


def test_summary_paragraphs():
    told = "<p>In this role you will<br>build all of it<br>Key Responsibilities<br>no</p><p>no</p>"
    assert intro_of(render(told), C.INTRO, C.INTRO_STOP) == "In this role you will build all of it"
    assert intro_of(render("<p>As a rule.</p><p>As a maker of chips you build things.</p>"), C.INTRO, C.INTRO_STOP) == "As a maker of chips you build things."
    assert intro_of(render("<p>In this role</p><p>you will build all of it</p>"), C.INTRO, C.INTRO_STOP) is None
    assert intro_of([], C.INTRO, C.INTRO_STOP) is None


def test_all_sections_of_a_page_in_one_pass(spark):
    df = spark.createDataFrame([(1, "<h2>The Role</h2><p>You design.</p><h2>Qualifications</h2><p>A degree</p>"), (2, None), (3, ""), (4, "<p>" + "word " * 50_000)], "k int, html string")
    found = df.select("k", D.located_sections(D.line_records("html"), C.ICIMS_SECTIONS).alias("f")).select("k", "f.role", "f.qualifications", "f.person", "f.intro")
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == [(1, ["You design."], ["A degree"], None, None), (2, None, None, None, None), (3, None, None, None, None), (4, None, None, None, None)]
    assert found.limit(0).count() == 0


@pytest.mark.parametrize(("html", "pay"), [("<p>Costs $5 - $9 a piece.</p><h3>Summary Pay Range:</h3><p>$99,900 - $135,150</p>", "$99,900 - $135,150"), ("<h3>Summary Pay Range</h3><p>ask</p><p>Pay is $5 - $9</p>", "$5 - $9"), ("<p>none</p>", None)])
def test_pay_of_its_own_section(spark, html, pay):
    assert spark.range(1).select(D.detail_record(F.lit("boeing"), F.lit(html)).alias("r")).first().r.salary_range == pay
