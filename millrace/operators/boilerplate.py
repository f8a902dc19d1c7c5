"""Boilerplate of postings: rules as a table, and paragraphs that repeat across the postings of a company.

Both mark lines and take none away: a line is struct(text, by), and `by` names what would drop it (null: it stays). Rules
are DataFrame expressions over a posting's own lines, without a shuffle.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.lines import once
from millrace.functions.scalars import squish
from millrace.sources.workspace import written


class Step(NamedTuple):
    """A row of a platform's table; steps are taken in order, each on the lines that those before it left.

    choose: `first` takes the first pattern that has a line, `all` takes them all. effect: which lines go, where a
    pattern is found: `line` itself, `until` (up to and with it), `before` (up to it), `after` (with all that follow)
    and `within` (only what matched, and the line if nothing is left).
    """

    name: str
    choose: str
    effect: str
    patterns: list[str]


#: Texts that the companies of a platform put into all their postings.
RULES = {
    "workday": [
        Step("opening", "first", "until", [r"Learn more about our benefits", r"care for you at work, at home, or wherever you may go\."]),
        Step("about", "all", "line", [r"^About Samsung", r"^Come innovate with us!?$", r"^About GlobalFoundries", r"^GlobalFoundries \(GF\) is", r"^Our vision is to transform how the world uses information", r"^Micron Technology is a world leader in innovating memory and storage solutions"]),
        Step("metadata", "first", "before", [r"^What You Will Do$"]),
        Step("description", "first", "until", [r"^Description$"]),
        Step("employer", "all", "line", [r"^At Northrop Grumman, our employees have incredible opportunities"]),
        Step("closing", "first", "after", [r"^Additional Information$", r"More information about NXP in the United States", r"^Total Rewards$", r"^Regular full-time employees \(salaried or hourly\) have access to benefits", r"^Life\s+@\s+Samsung", r"^U\.S\. Export Control", r"^Trade Secrets Notice", r"^What We Offer$", r"^As a full-time employee of Northrop Grumman"]),
        Step("equal", "all", "after", [r"Applied Materials is an Equal Opportunity", r"If you would like to contact us regarding accessibility", r"Qualified applicants will receive consideration", r"salary offered to a selected candidate", r"NXP Semiconductors N\.V\. is an equal opportunity", r"equal opportunity employer", r"^Reasonable Accommodations", r"RTX is an Equal Opportunity", r"^Privacy Policy and Terms:", r"GlobalFoundries is an equal opportunity", r"^An offer of employment", r"^Benefits at Intel$"]),
        Step("notices", "all", "line", [r"^As part of our commitment to maintaining a secure hiring process", r"^The salary range for this role is", r"^Hired applicants may be eligible for benefits", r"^This role is a U\.S\.-based role", r"^RTX anticipates the application window closing", r"^All positions at (?:Samsung Austin Semiconductor|SAS) require you to be onsite"]),
    ],
    "icims": [
        Step("opening", "all", "line", [r"^WHAT YOU DO AT AMD CHANGES EVERYTHING", r"^Together,? we advance your career"]),
        Step("closing", "all", "after", [r"^(?:At AMD,? )?(?:we )?(?:it is our policy to provide|AMD is committed to)", r"^Benefits offered", r"^AMD does not accept unsolicited resumes", r"^This role is not eligible for visa sponsorship\.", r"^(?:This role is eligible for Keysight Results Bonus|US Employees may be eligible for the following benefits)", r"^\*{0,3}Keysight is an Equal Opportunity Employer", r"^Careers Privacy Statement"]),
    ],
    "successfactors": [
        Step("opening", "first", "line", [r"^Qorvo\s*\(Nasdaq:\s*QRVO\)", r"^TSMC is the world.s leading", r"^About TSMC", r"^(?:At )?Lam Research"]),
        Step("closing", "first", "after", [r"MAKE A DIFFERENCE AT QORVO", r"^TSMC is an equal opportunity employer", r"^Please be informed that TSMC", r"^As a valued member of the TSMC family", r"^Candidates must be willing and able to work on-site", r"^Work Location\s*:", r"^Lam Research is an equal opportunity employer", r"^Our Perks and Benefits"]),
    ],
    "oracle": [
        Step("phrases", "all", "within", [r"Change the world\.\s*Love your job\.\s*", r"Put your talent to work with us[^.!]*[.!]\s*", r"Texas Instruments will not sponsor[^.]*\.\s*", r"TI will not sponsor[^.]*\.\s*"]),
        Step("paragraphs", "all", "line", [r"^Texas Instruments Incorporated \(TI\) is a global semiconductor", r"^Texas Instruments is an equal opportunity", r"^If you are interested in this position", r"^All qualified applicants will receive", r"^Why TI\s*$", r"^About Texas Instruments\s*$"]),
    ],
}
LINE = "array<struct<text:string,by:string>>"


def _taken(lines: Column, step: Step) -> Column:
    """Lines after one step."""
    patterns = [f"(?i){p}" for p in step.patterns] if step.choose == "first" else ["(?i)" + "|".join(step.patterns)]

    def mark(own: Column) -> Column:
        if step.effect == "within":
            cut = lambda x: F.when(x["by"].isNull() & x["text"].rlike(patterns[0]), squish(F.regexp_replace(x["text"], patterns[0], "")))
            return F.transform(own, lambda x: F.struct(F.coalesce(F.nullif(cut(x), F.lit("")), x["text"]).alias("text"), F.when(cut(x) == "", step.name).otherwise(x["by"]).alias("by")))
        if step.effect == "line" and step.choose == "all":
            return F.transform(own, lambda x: F.struct(x["text"].alias("text"), F.when(x["by"].isNull() & x["text"].rlike(patterns[0]), step.name).otherwise(x["by"]).alias("by")))
        place = lambda p: F.array_position(F.transform(own, lambda x: x["by"].isNull() & x["text"].rlike(p)), True)
        first = F.coalesce(*[F.nullif(place(p), F.lit(0)) for p in patterns], F.lit(0))
        goes = {"line": lambda i, at: i == at, "until": lambda i, at: i <= at, "before": lambda i, at: i < at, "after": lambda i, at: i >= at}[step.effect]
        one = lambda x, i, at: F.struct(x["text"].alias("text"), F.when(x["by"].isNull() & (at > 0) & goes(i + 1, at), step.name).otherwise(x["by"]).alias("by"))
        return once(first, lambda at: F.transform(own, lambda x, i: one(x, i, at)))

    return once(lines, mark)


def marked_lines(platform: Column, lines: Column, rules: dict[str, list[Step]] = RULES) -> Column:
    """array of struct(text, by) from a posting's lines: `by` is the step that drops the line.

    A platform without rules keeps all lines; a null array gives null, an empty one none; a line that is null or blank
    matches nothing and stays.
    """
    start = F.transform(lines, lambda x: F.struct(x.alias("text"), F.lit(None).cast("string").alias("by")))
    out = start
    for name, steps in rules.items():
        out = F.when(platform == name, reduce(_taken, steps, start)).otherwise(out)
    return out.cast(LINE)


def kept_lines(marked: Column) -> Column:
    """Texts of the lines that stay."""
    return F.transform(F.filter(marked, lambda x: x["by"].isNull()), lambda x: x["text"])


#: A company with over 1 of so many postings is looked up by broadcast; so fewer than this are.
OFTEN = 100_000


def mark_repeated(postings: DataFrame, company: str, marked: str, share: float = 0.5, least: int = 20) -> DataFrame:
    """postings with the lines marked as `repeated` that stand in `share` of their company's postings, and in `least`.

    Lines are counted by hash, once a posting, over all postings, and tasks sum before the shuffle, so neither a huge
    company nor a line of all its postings fills a task. A company has at most (lines a posting) / share such lines.
    Only lines that no rule drops are counted or marked. Postings without a company, and blank lines, stay as they are;
    an empty table gives an empty table.
    """
    rows = written(postings, "postings")
    hashes = F.transform(F.filter(F.col(marked), lambda x: x["by"].isNull() & (F.length(F.trim(x["text"])) > 0)), lambda x: F.xxhash64(x["text"]))
    lines = rows.filter(F.col(company).isNotNull()).select(F.col(company).alias("of"), F.explode(F.array_distinct(hashes)).alias("h")).groupBy("of", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    sizes = written(rows.filter(F.col(company).isNotNull()).groupBy(F.col(company).alias("whose")).agg(F.count("*").alias("postings")), "companies")
    found = lines.join(sizes, F.col("of") == F.col("whose")).filter(F.col("n") >= F.col("postings") * share)
    found = written(found.groupBy("of").agg(F.collect_list("h").alias("repeated"), F.max("postings").alias("postings")), "repeated")
    own = rows.select(F.struct(*rows.columns).alias("own"), F.col(company).alias("mine"))
    often = F.col("postings") * OFTEN > rows.count()
    met = own.join(F.broadcast(found.filter(often).drop("postings")), F.col("mine") == F.col("of"), "left")
    rest = met.filter("of is null").select("own", "mine").join(found.filter(~often).drop("postings"), F.col("mine") == F.col("of"), "left")
    both = met.filter("of is not null").unionByName(rest)
    again = F.transform(F.col(f"own.{marked}"), lambda x: F.struct(x["text"].alias("text"), F.when(x["by"].isNull() & F.array_contains("repeated", F.xxhash64(x["text"])), "repeated").otherwise(x["by"]).alias("by")))
    return both.select(*[F.when(F.col("of").isNull(), F.col(f"own.{c}")).otherwise(again).alias(c) if c == marked else F.col(f"own.{c}").alias(c) for c in rows.columns])
