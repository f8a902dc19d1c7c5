"""Lines that rules or repetition drop."""

from pyspark.sql import functions as F

from millrace.operators.boilerplate import Step, kept_lines, mark_repeated, marked_lines


def test_effects_and_choices(spark):
    rules = {
        "first": [Step("s", "first", "after", ["^zeta", "^beta"])],
        "all": [Step("s", "all", "after", ["^zeta", "^beta"])],
        "until": [Step("s", "first", "until", ["^beta"])],
        "before": [Step("s", "first", "before", ["^beta"])],
        "one": [Step("s", "first", "line", ["^beta"])],
        "within": [Step("s", "all", "within", [r"beta\s*", "ta"])],
        "two": [Step("s", "first", "until", ["^beta"]), Step("t", "all", "line", ["^beta", "^eta"])],
    }
    lines = ["alpha", None, "", "beta", "beta", "zeta", "eta"]
    marks = {"first": [5, 6], "all": [3, 4, 5, 6], "until": [0, 1, 2, 3], "before": [0, 1, 2], "one": [3], "within": [3, 4], "two": [0, 1, 2, 3, 4, 6], "none": []}
    df = spark.createDataFrame([(p, lines) for p in marks] + [("first", None), ("first", []), (None, ["zeta"])], "p string, lines array<string>")
    got = df.select("p", marked_lines(F.col("p"), F.col("lines"), rules).alias("m")).withColumn("kept", kept_lines(F.col("m"))).collect()
    for r in got[: len(marks)]:
        assert [i for i, x in enumerate(r.m) if x.by] == marks[r.p], r.p
    within = next(r.m for r in got if r.p == "within")
    assert [x.text for x in within] == ["alpha", None, "", "beta", "beta", "ze", "e"]
    assert {x.by for x in next(r.m for r in got if r.p == "two")[4:5]} == {"t"}
    assert [(r.m, r.kept) for r in got[len(marks) : -1]] == [(None, None), ([], [])] and got[-1].kept == ["zeta"]


def test_repeated_lines_of_a_company(spark, monkeypatch):
    rows = [(i, "big" if i % 3 else None if i % 2 else f"c{i % 4}", ["same", f"own {i}", "", "half" if i % 4 == 1 else None, "same"]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, of string, lines array<string>").withColumn("lines", marked_lines(F.lit("x"), F.col("lines"))).withColumn("h", F.lit(1))
    for often in (100_000, 0):
        monkeypatch.setattr("millrace.operators.boilerplate.OFTEN", often)
        got = {r.id: r for r in mark_repeated(df, "of", "lines", 0.5, 26).collect()}
        assert len(got) == 300 and set(got[0].asDict()) == {"id", "of", "lines", "h"}
        for i, of, lines in rows:
            large = of == "big"  # the others have 25 postings
            assert [x.by for x in got[i].lines] == ["repeated" if large and t == "same" else None for t in lines]
    assert mark_repeated(df.limit(0), "of", "lines").count() == 0
