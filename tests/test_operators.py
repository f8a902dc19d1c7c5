"""Operators on small frames: nulls, ties, golden values and the store's fold against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import htmltext as H
from millrace.functions import scalars as S
from millrace.operators import details as D
from millrace.operators import store
from millrace.operators.supply import clean_extract, distinct_with_null, snake_case, total
from millrace.sources import captured


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("text", "code"), [("11070100 - Computer Science", "11.0701"), ("15000000 - X", "15.0000"), (" 14109900  - Y", "14.1099"), ("Cybersecurity Defense", None), ("1107010 - Z", None), ("11070100", "11.0701"), (None, None)])
def test_codes(spark, text, code):
    assert one(spark, S.standardize_code, text) == code


@pytest.mark.parametrize(("text", "day"), [("2026-02-03", "2026-02-03"), ("2/3/2026", "2026-02-03"), ("13/02/2026", "2026-02-13"), ("February 3, 2026", "2026-02-03"), ("Feb 3, 2026", "2026-02-03"), ("2026-02-03T10:00:00", "2026-02-03"), ("Posted Today", "2026-03-31"), ("Posted: 01/02/2026", "2026-01-02"), ("Posted Yesterday", "2026-03-30"), ("Posted 30+ Days Ago", "2026-03-01"), ("2 weeks ago", "2026-03-17"), ("a month ago", "2026-02-28"), ("soon", "2026-03-31"), ("", None), (None, None)])
def test_dates(spark, text, day):
    got = one(spark, lambda x: S.parse_date(x, F.lit("2026-03-31").cast("date")), text)
    assert (got and str(got)) == day


def test_scalars(spark):
    assert one(spark, S.slug, "--A & B, Inc.--") == "a_b_inc"
    assert one(spark, S.squish, "a  \n b ") == "a b"
    assert one(spark, S.sanitize, "a\n\x07 b\x00c") == "a bc"
    assert one(spark, S.clean_text, " x ") is None
    assert one(spark, S.salary, "86,800 USD - 165,200 USD") == "$86,800-$165,200"
    assert one(spark, S.salary, "from $100,000+") == "$100,000+" and one(spark, S.salary, "none") is None
    assert one(spark, S.decode_entities, "a&nbsp;&amp;lt;&rsquo;") == "a &lt;’"
    assert snake_case("CIPGroupDesc") == "cip_group_desc" and snake_case("DimYear") == "dim_year"


def test_sums_and_distinct(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.1), (None, 2.2)], "k string, v double")
    assert {r.k: r.t for r in df.groupBy("k").agg(total(F.col("v")).alias("t")).collect()} == {"a": 0.0, "b": 1.1, None: 2.2}
    assert df.agg(distinct_with_null("k").alias("n")).first().n == 3 and df.limit(0).agg(distinct_with_null("k").alias("n")).first().n == 0


def test_extract_is_cleaned(spark):
    raw = spark.createDataFrame([("2019", "Public", "State", "Computing", "11070100 - Computer Science", 412), ("2020", "Public", "State", "Misc", "Cybersecurity", 3), ("x", "Public", "State", "Arts", "11070100 - CS", None), ("2020", "P", "S", "A", "50070100 - Art", 9)], "DimYear string, InstTypeList string, InstList string, CIPGroupDesc string, CIPDesc string, Count int")
    codes = spark.createDataFrame([("11.0701", "11", "Computing")], "cip_code string, cip_family string, cip_category string")
    rows = clean_extract(raw, codes, "University", "Enrollment").collect()
    assert sorted((r.academic_year or 0, r["count"] or 0, r.cip_family, r.institution_sector) for r in rows) == [(0, 0, "11", "University"), (2019, 412, "11", "University")]


def test_upsert_equals_row_by_row(spark):
    r = random.Random(1)
    for _ in range(3):
        target = {k: ("T", "S", k) for k in range(4)}
        batch = [(r.randint(0, 6), i, r.choice(["a", "b", None]), r.choice(["x", None])) for i in range(r.randint(1, 25))]
        t = spark.createDataFrame([(k, *v) for k, v in target.items()], "k int, title string, pay string, company int")
        b = spark.createDataFrame(batch, "k int, ord int, title string, pay string").repartition(3)
        new = 0
        want = dict(target)
        for k, _, title, pay in batch:
            new += k not in want
            old = want.get(k, (None, None, -1))
            want[k] = (title, pay if pay is not None else old[1], old[2])
        got = store.upsert(t, b, "k", "ord", ["title"], ["pay"], {"company": F.lit(-1)})
        assert {x.k: (x.title, x.pay, x.company) for x in got.collect()} == want
        assert tuple(store.upsert_counts(t, b, "k").first()) == (new, len(batch) - new)
    assert tuple(store.upsert_counts(t, b.limit(0), "k").first()) == (0, 0)


def test_least_by_and_new_companies(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", None, "x"), ("b", 1, "y"), ("b", 1, "w"), (None, 3, "z")], "k string, o int, v string")
    assert sorted(map(str, map(tuple, store.least_by(df, ["k"], [F.col("o"), F.col("v")]).collect()))) == sorted(map(str, [("a", None, "x"), ("b", 1, "w"), (None, 3, "z")]))
    known = spark.createDataFrame([("b", 7, "u")], "k string, id int, url string")
    new = spark.createDataFrame([("c", "2"), ("a", "1"), ("c", "1"), ("b", "other")], "k string, url string")
    assert sorted(map(tuple, store.add_companies(known, new, "k", "id").collect())) == [("a", 8, "1"), ("b", 7, "u"), ("c", 9, "1")]
    assert sorted(map(tuple, store.add_companies(known.limit(0), new, "k", "id").collect())) == [("a", 1, "1"), ("b", 2, "other"), ("c", 3, "1")]


def test_failed_run_stays_failed(spark):
    runs = spark.createDataFrame([(1, "running", None, 0, 0, 0), (2, "running", None, 0, 0, 0)], "run_id int, status string, error_message string, jobs_found int, jobs_new int, jobs_updated int")
    out = store.finish_run(store.finish_run(runs, 1, 0, 0, 0, "failed", "boom"), 1, 0, 0, 0)
    assert [(x.run_id, x.status, x.error_message) for x in out.orderBy("run_id").collect()] == [(1, "failed", "boom"), (2, "running", None)]


def test_titled_csv_and_exports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(b"Title line,\nDimYear,InstList,Count,\n2019,\"Sample, College\",4,\n2020,St. P\x92s \xe2\x86\x92,,\r\n2021,\"Two\nlines of \"\"it\"\"\",5,\n")
    rows = captured.read_titled_csv(spark, str(tmp_path / "in"), "DimYear int, InstList string, Count int").orderBy("DimYear").collect()
    assert [tuple(r) for r in rows] == [(2019, "Sample, College", 4), (2020, "St. P’s →", None), (2021, 'Two\nlines of "it"', 5)]
    (tmp_path / "out").mkdir()
    for name in ("jobs_nxp_20260101.csv", "jobs_nxp_20260301.csv", "jobs_all_companies_20260301.csv", "jobs_allegro_20260101v2.csv"):
        (tmp_path / "out" / name).write_text("job_title,job_identification\nA,NA\n")
    (tmp_path / "out" / "jobs_amd_20260101.csv").write_text("extra,job_identification,job_title\n1,7,\"B\nb\"\n")
    got = captured.read_exports(spark, str(tmp_path / "out"), "job_title string, job_identification string")
    assert sorted((r.slug, r.day, r.job_identification) for r in got.collect()) == [("allegro", "20260101", None), ("amd", "20260101", "7"), ("nxp", "20260101", None), ("nxp", "20260301", None)]
    assert {r.slug: r.job_title for r in got.collect()} == {"allegro": "A", "nxp": "A", "amd": "B\nb"}
    captured.write_export(got, str(tmp_path / "w"))
    assert "NA" in "".join(p.read_text() for p in (tmp_path / "w").glob("part-*"))


def test_sections_of_all_heading_styles():
    for head in ("<h2>Responsibilities</h2>", "<h3><b>Respon</b><b>sibilities:</b></h3>", "<p><strong>Responsibilities</strong></p>", "<p>Responsibilities:</p>", "<div><p><span>Respon</span><span>sibilities</span></p></div>"):
        html = f"{head}<ul><li>First duty<li>Second &amp; last</ul><h2>Other</h2><ul><li>no</ul>"
        assert H.section(H.render(html), ["Responsibilities"], H.Policy()) == ["First duty", "Second & last"]
    lines = H.render("<p>Responsibilities: all on one line of text</p><p><b>End</b></p>")
    assert H.section(lines, ["Responsibilities"], H.Policy()) == ["all on one line of text"]
    twice = H.render("<h2>Duties</h2><p>old text</p><h2>Duties</h2><p>new text</p>")
    assert H.section(twice, ["Duties"], H.Policy(last=True)) == ["new text"] and H.section(twice, ["Nothing"], H.Policy()) is None


def test_line_classes_differ_by_platform():
    assert D.split_required("talentbrew", ["education in arts", "5 years of experience", "Bachelor degree and 3 years experience", "other"]) == (["education in arts"], ["5 years of experience", "Bachelor degree and 3 years experience", "other"])
    assert D.split_required("dayforce", ["Knows tools", "Education: BS in EE"]) == (["BS in EE"], ["Knows tools"])
    assert D.split_required("boeing", ["mastering tools", "BSEE or so"]) == (["BSEE or so"], ["mastering tools"])
    assert D.split_required("oracle", ["a", "b"]) == (["a", "b"], [])
    assert D.detail("successfactors", "Pay $50,000 - 70,000 a year")[4] == "$50,000 - 70,000"
    assert D.detail("successfactors", "<b>Qualifications</b><ul><li>Bachelor degree - OR - five years</ul>")[1:3] == ("Bachelor degree", "five years")


def test_detail_errors_stay_in_their_row(spark):
    df = spark.createDataFrame([("workday", None), ("workday", ""), (None, "<h2>Responsibilities</h2><p>text here")], "p string, h string")
    rows = df.select(D.detail_record("p", "h").alias("r")).select("r.*").collect()
    assert [r.job_responsibilities for r in rows] == [None, None, "text here"] and all(r.error is None for r in rows)
    assert H.repair_bytes("ok →".encode() + b"\x92") == "ok →’" and H.strip_boilerplate("aXbY", [("first", "X"), ("first", "Y"), ("all", "b")]) == "aY"


def test_ingest(spark):
    from millrace.operators.ingest import ingest, latest_exports

    body = "<h2>Responsibilities</h2><ul><li>Build\x07 things</ul><h2>Qualifications</h2><ul><li>Bachelor degree<li>3 years experience</ul><p>$10 - $20</p>"
    rows = [("workday", "A", "u1", "T1", "Austin, TX", body, "Posted Today", 1), ("boeing", "B", "u2", "T2", None, body, None, 2), ("successfactors", "C", "u1", "T3", "x TX", "", "2026-01-05", 3), ("boeing", "B", "u3", "T4", "Everett, Washington", body, "", 4), ("other", "D", "u4", "T5", None, None, None, 5), ("talentbrew", "E", "u5", "T6", "Paris, France", body, None, 6)]
    pay = spark.createDataFrame(rows, "platform string, company_name string, url string, title string, location string, body string, posted string, ord int").withColumn("as_of", F.lit("2026-03-31").cast("date"))
    empty = spark.createDataFrame([], "job_url string, company_name string, job_title string, location string, posting_date date, job_responsibilities string, min_education string, min_experience string, preferred_qualifications string, salary_range string")
    got = {r.job_url: r for r in ingest(empty, pay).collect()}
    assert set(got) == {"u1", "u3", "u4"}
    assert (got["u1"].company_name, got["u1"].job_title, got["u1"].job_responsibilities, got["u1"].salary_range, str(got["u1"].posting_date)) == ("A", "T3", "Build things", "$10 - $20", "2026-01-05")
    again = {r.job_url: r for r in ingest(ingest(empty, pay), pay.filter("url = 'u3'").withColumn("company_name", F.lit("Z"))).collect()}
    assert again["u3"].company_name == "B" and set(again) == set(got)
    days = spark.createDataFrame([("nxp", "20260101", "a"), ("nxp_semiconductors", "20260301", "c"), ("nxp", "20260301", "b"), ("nxp", "20260301", "b"), ("x", "20250101", "d")], "slug string, day string, path string")
    assert sorted(map(tuple, latest_exports(days).collect())) == [("nxp", "20260301", "b"), ("nxp", "20260301", "b"), ("x", "20250101", "d")]
