"""Batched pulls and the sections of plain heading lines."""

import pytest

from millrace.operators.dayforce import dayforce_details
from millrace.operators.pulls import in_batches, pull, pulled_rows, report


def answers(members, attempt):
    if any(m["name"] == "broken" for m in members):
        raise ConnectionError("gone")
    for m in members:
        yield {"text": m["name"], "n": attempt}
        if m["name"] == "breaks off" and attempt < 3:
            raise TimeoutError("half way")


def test_a_failed_batch_takes_no_other_with_it(spark):
    names = ["a", "a", None, "breaks off", "b", "broken", "c"]
    df = spark.createDataFrame([(i, x, i) for i, x in enumerate(names)], "id int, name string, batch int").select("id", "name")
    got = pull(in_batches(df, ["id"], 2), answers, "n int, text string")
    assert sorted((r.batch, r.n, r.text or "") for r in pulled_rows(got).collect()) == [(1, 1, "a"), (1, 1, "a"), (2, 3, ""), (2, 3, "breaks off"), (4, 1, "c")]
    assert sorted(map(tuple, report(got).collect())) == [(1, 1, None, 2), (2, 3, None, 2), (3, 3, "ConnectionError: gone", 0), (4, 1, None, 1)]
    once = pull(in_batches(df, ["id"], 2), answers, "n int, text string", attempts=1)
    assert {r.batch: r.error for r in report(once).collect()} == {1: None, 2: "TimeoutError: half way", 3: "ConnectionError: gone", 4: None}


def test_empty_pulls(spark):
    df = spark.createDataFrame([], "id int, name string")
    assert report(pull(in_batches(df, ["id"], 2), answers, "n int, text string")).count() == 0
    some = spark.createDataFrame([(1, "a")], "id int, name string")
    nothing = pull(in_batches(some, ["id"], 2), lambda members, attempt: [], "n int, text string")
    assert report(nothing).collect() == [(1, 1, None, 0)] and pulled_rows(nothing).count() == 0


PLAIN = {
    "summary alone": (["We build"], (None, None, None, None)),
    "all": (["Responsibilities", "Build", "Required Qualifications:", "Eyes", "Education: BA", "MS", "Preferred Qualification", "Humour"], ("Build", "BA", "Eyes\nMS", "Humour")),
    "the last of a name": (["Responsibilities", "Build", "Responsibilities:", "Run", "RESPONSIBILITIES"], ("Run", None, None, None)),
    "own sections first": (["Education", "none", "Required Qualifications", "* BS", "* Eyes"], (None, "none", "Eyes", None)),
    "no degree": (["Required Qualifications", "•", "• Eyes", "MSc of any kind"], (None, None, "Eyes\nMSc of any kind", None)),
    "blank lines": (["", " ", "Position   Summary", "\t", None], (None, None, None, None)),
    "empty": ([], (None, None, None, None)),
    "null": (None, (None, None, None, None)),
}


def test_dayforce_shapes(spark):
    df = spark.createDataFrame([(k, v[0], "own") for k, v in PLAIN.items()], "name string, lines array<string>, s string")
    got = {r.name: r for r in dayforce_details(df).collect()}
    assert {k: tuple(r)[3:] for k, r in got.items()} == {k: v[1] for k, v in PLAIN.items()} and got["all"].s == "own"
    assert dayforce_details(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 7])
def test_long_postings(spark, n):
    lines = ["Responsibilities"] + ["word " * 2000] * 50 * n
    assert len(dayforce_details(spark.createDataFrame([(lines,)], "lines array<string>")).first().job_responsibilities.split("\n")) == 50 * n
