"""Postings of the platform whose headings are plain lines: a section is what follows a heading line.

All of it is expressions over the array of a posting's lines, without a shuffle: the places of the headings cut the
array into sections, fields take sections by a part of their name, and the block of requirements is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.lines import joined, once
from millrace.functions.scalars import squish

#: The headings, and what opens a line on education.
HEADING = r"(?i)^(?:responsibilities|position\s+summary|required\s+qualifications?|education|experience\s+and\s+skills?|preferred\s+qualifications?|us\s+citizenship\s+required)\s*:?\s*$"
DEGREE = r"(?i)^(?:High\s+School|GED|B\.S\.|B\.A\.|M\.S\.|BS(?!\w)|MS(?!\w)|Ph\.?D|Bachelor|Master|Associate)"
LABEL = r"(?i)^Education:\s+"
FIELDS = ["job_responsibilities", "min_education", "min_experience", "preferred_qualifications"]


def sections(lines: Column) -> Column:
    """array of (name, lines) in the page's order, without empty ones; what is before the first heading is `summary`.

    A name is the heading in lower case with underscores, without its colon. Blank lines are left out.
    """
    kept = F.filter(F.transform(lines, squish), lambda x: F.length(x) > 0)

    def cut(own: Column) -> Column:
        heads = F.array_compact(F.transform(own, lambda x, i: F.when(x.rlike(HEADING), F.struct(F.regexp_replace(F.lower(F.regexp_extract(x, r"^[A-Za-z ]+", 0)), r"\s+", "_").alias("name"), (i + 1).alias("at")))))
        every = F.concat(F.array(F.struct(F.lit("summary").alias("name"), F.lit(0).alias("at"))), heads)

        def bodies(spots: Column) -> Column:
            def one(spot: Column, k: Column) -> Column:
                end = F.coalesce(F.get(spots, k + 1)["at"] - 1, F.size(own))
                return F.struct(spot["name"].alias("name"), F.slice(own, spot["at"] + 1, F.greatest(F.lit(0), end - spot["at"])).alias("lines"))

            return F.filter(F.transform(spots, one), lambda s: F.size(s["lines"]) > 0)

        return once(every, bodies)

    return once(F.coalesce(kept, F.array().cast("array<string>")), cut)


def section_named(found: Column, part: str) -> Column:
    """Lines of the first section whose name holds a part; of several of that name the last. Null without any."""
    first = F.get(F.filter(found, lambda s: s["name"].contains(part)), 0)["name"]
    return F.try_element_at(F.filter(found, lambda s: s["name"] == first), F.lit(-1))["lines"]


def dayforce_details(df: DataFrame, lines_col: str = "lines") -> DataFrame:
    """df with FIELDS, from a column of plain lines.

    Of the required qualifications, the first line labelled as education, or else the first that opens with a degree,
    is the education where no section is; the other lines are the experience where no section is. Null or empty
    lines give nulls; equal rows are read one by one.
    """
    out = df.select(F.struct(*df.columns).alias("own"), sections(F.col(lines_col)).alias("s"))
    named = {name: F.when(F.size("s") > 0, section_named(F.col("s"), part)) for name, part in (("duties", "responsibilit"), ("edu", "education"), ("exp", "experience"), ("pref", "preferred"), ("req", "required_qual"))}
    out = out.select("own", *[x.alias(n) for n, x in named.items()])
    plain = F.filter(F.transform("req", lambda x: squish(F.regexp_replace(x, r"^[•\-*]\s*", ""))), lambda x: F.length(x) > 0)
    out = out.withColumn("req", plain)

    def first(pattern: str) -> Column:
        return F.array_min(F.array_compact(F.transform("req", lambda x, i: F.when(x.rlike(pattern), i))))

    out = out.withColumn("at", F.coalesce(first(LABEL), first(DEGREE)))
    line = F.regexp_replace(F.get("req", F.col("at")), LABEL, "")
    rest = F.filter("req", lambda _, i: F.col("at").isNull() | (i != F.col("at")))
    fields = [joined(F.col("duties")), F.coalesce(joined(F.col("edu")), line), F.coalesce(joined(F.col("exp")), joined(rest)), joined(F.col("pref"))]
    return out.select("own.*", *[x.alias(n) for n, x in zip(FIELDS, fields, strict=True)])
