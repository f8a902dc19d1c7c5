"""Costly work on the rows of a small file is dealt over tasks, and a listing's values are worked out once."""

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import QUERIES
from millrace.operators import ingest
from millrace.operators.spread import WAVES, spread
from millrace.sources import listings


def tasks(df):
    """How many tasks have rows, and the rows of the fullest one."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    return len(sizes), max(sizes)


@pytest.mark.parametrize("name", ["detail_record", "workday_fields", "role_intro", "form_sections", "dayforce_fields", "icims_fields", "html_sections", "paragraph_section", "talentbrew_listing", "boeing_listing", "successfactors_listing"])
def test_rows_are_dealt_over_the_cores(spark, sf, name):
    cores, df = spark.sparkContext.defaultParallelism, QUERIES[name](spark, sf)
    n, most = tasks(df)
    assert n >= cores and most * cores <= df.count() + cores * WAVES * cores


@pytest.mark.parametrize("name", ["ingest_batch", "ingest_platforms"])
def test_pages_are_parsed_in_many_tasks(spark, sf, name, monkeypatch):
    seen, written = [], ingest.written
    monkeypatch.setattr(ingest, "written", lambda df, to: seen.append(tasks(df)) or written(df, to))
    QUERIES[name](spark, sf)
    assert [n >= spark.sparkContext.defaultParallelism for n, _ in seen] == [True]


def test_spread_keeps_all_rows(spark):
    df = spark.range(1000, numPartitions=1).withColumn("v", F.when(F.col("id") % 2 == 0, "x"))
    assert sorted(map(tuple, spread(df.union(df)).collect())) == sorted(map(tuple, df.union(df).collect()))
    assert spread(df.limit(0)).count() == 0


def test_links_are_looked_for_once(spark):
    assert str(listings.result_items(F.col("h"), F.lit("b"))).count("sr-job-link") == 1
    rows = str(listings.table_rows(F.col("h"), F.lit("b")))
    assert rows.count("jobTitle-link") == 1 and rows.count("data-row") == 1
