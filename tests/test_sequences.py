"""Ordinals, frames side by side, probes, and the store on disk."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.ingest import ingest
from millrace.operators.kept import Store
from millrace.operators.sequences import probed, side_by_side, with_ordinal
from millrace.sources.captured import read_company_exports, write_company_exports
from millrace.sources.workspace import workspace


def slow_probe(ids, first, last, step, misses, after_first_hit):
    seen, run = [], None if after_first_hit else 0
    for i in range(first, last + 1, step):
        if i in ids:
            seen.append(i)
            run = 0
        elif run is not None:
            run += 1
            if run == misses:
                break
    return seen


@pytest.mark.parametrize("misses", [3, 10, 500])
def test_a_probe_gives_up_where_a_loop_does(spark, misses, monkeypatch):
    import millrace.operators.sequences as s

    monkeypatch.setattr(s, "LEAST_WIDTH", 16)
    monkeypatch.setattr(s, "RANGES", 8)
    r = random.Random(misses)
    for first, step, after in ((0, 1, True), (0, 1, False), (-50, 1, True), (-50, 1, False), (2, 5, True), (2, 5, False)):
        ids = {r.randrange(20, 400) for _ in range(r.choice([0, 20, 150]))} | {r.randrange(600, 700) for _ in range(40)}
        df = spark.createDataFrame([(i,) for i in ids] * 2 + [(None,)], "id long")
        assert sorted(x.id for x in probed(df, "id", first, 690, step, misses, after).collect()) == slow_probe(ids, first, 690, step, misses, after)


def test_rows_side_by_side(spark):
    r = random.Random(3)
    keys = r.sample(range(10_000), 300)
    a = spark.createDataFrame([(k, f"a{k}") for k in keys] + [(None, "null first")], "k long, title string").repartition(5)
    b = spark.createDataFrame([(i, f"b{i}") for i in range(301)], "place long, duties string").repartition(3)
    got = sorted(map(tuple, side_by_side(a, b, ["k"], ["place"]).select("ordinal", "title", "duties").collect()))
    assert got == [(i, t, f"b{i}") for i, t in enumerate(["null first", *(f"a{k}" for k in sorted(keys))])]
    with pytest.raises(ValueError, match="301 rows can't stand beside 300"):
        side_by_side(a, b.filter("place > 0"), ["k"], ["place"])
    assert side_by_side(a.limit(0), b.limit(0), ["k"], ["place"]).count() == with_ordinal(a.limit(0), ["k"]).count() == 0


def test_a_batch_rewrites_its_buckets_alone(spark):
    store = Store(spark, workspace(spark, "store"), "url string, title string, note string, company string", "url", ["title"], ["note"], buckets=32)
    kind = "url string, title string, note string, company string, ord long"
    files = lambda: {r.f: r.n for r in store.read().groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()}
    assert store.read().count() == 0
    store.apply(spark.createDataFrame([(f"u{i}", "t", "n", "c", i) for i in range(200)] + [(None, "no url", None, None, 1)], kind), "ord", 1, "2026-01-01 00:00:00")
    before = files()
    assert sum(before.values()) == 200
    store.apply(spark.createDataFrame([("u5", "x", "kept", "other", 1), ("u5", None, None, "later", 2), ("new", "y", None, "first", 4), ("new", "z", None, "second", 3)], kind), "ord", 2, "2026-02-01 00:00:00")
    after = files()
    assert len(set(before) - set(after)) <= 2 and len(set(before) & set(after)) >= len(before) - 2
    rows = {r.url: r for r in store.read().collect()}
    assert len(rows) == 201 and tuple(rows["u5"])[1:5] == (None, "kept", "c", 2) and tuple(rows["new"])[1:5] == ("y", None, "second", 2)
    assert (str(rows["u5"].created_at), str(rows["u5"].updated_at), str(rows["u6"].updated_at)) == ("2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-01-01 00:00:00")
    # a batch that dies before its manifest changes nothing
    store.apply(spark.createDataFrame([], kind), "ord", 3, "2026-03-01 00:00:00")
    spark.range(3).write.parquet(f"{store.path}/data/99999999-dead/bucket=1")
    assert files() == after


def payload(spark, rows):
    kind = "platform string, company_name string, url string, title string, location string, body string, posted string, as_of date, ord long, job_identification string, filters struct<q:string,states:array<string>,country_facet:boolean>"
    return spark.createDataFrame(rows, kind)


def test_a_posting_that_comes_again(spark):
    """Titles and identifiers are overwritten, null or not; details stay. What the listing looked for decides on places."""
    from datetime import date

    day = date(2026, 3, 31)
    row = lambda platform, url, number, filters, place=None: (platform, "c", url, "t", place, "", None, day, 1, number, filters)
    empty = spark.createDataFrame([], "job_url string, company_name string, job_title string, location string, posting_date date, job_responsibilities string, min_education string, min_experience string, preferred_qualifications string, salary_range string")
    first = ingest(empty, payload(spark, [row("oracle", "u", "R-1", None), row("workday", "w1", None, None, "Sydney, Australia"), row("workday", "w2", None, ("", [], True), "Sydney, Australia"), row("workday", "w3", None, ("", ["Texas"], False), "Austin, Texas"), row("workday", "w4", None, ("", ["Texas"], False), "Reno, Nevada"), row("workday", "w5", None, ("TX", None, None), "US-TX-Austin"), row("workday", "w6", None, ("TX", None, None), "US-NV-Reno")]))
    assert {r.job_url: r.job_identification for r in first.collect()} == {"u": "R-1", "w2": None, "w3": None, "w5": None}
    again = ingest(first, payload(spark, [row("oracle", "u", None, None)]))
    assert {r.job_url: r.job_identification for r in again.collect()}["u"] is None


def test_a_huge_company_is_written_in_several_tasks(spark):
    folder = workspace(spark, "exports")
    rows = spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("slug"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        write_company_exports(rows.select("id", "text", "slug"), folder, "20260101", F.col("slug"), rows_per_file=4000)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    back = read_company_exports(spark, folder, "id long, text string, slug string")
    assert back.count() == back.select("id").distinct().count() == 30_000
    files = {r.slug: r["count"] for r in back.select("slug", F.input_file_name().alias("f")).distinct().groupBy("slug").count().collect()}
    assert files["big"] >= 3 and max(files.values()) == files["big"]
