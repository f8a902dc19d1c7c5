"""Detail records of postings: headings, line classes and pay by platform, in one struct.

The order of each platform's patterns is part of the result: the first that has a section wins. A page
that cannot be read gives nulls and the error's text, never a failed job.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.forms import ANY, HEADS, Rules, intro_of, section_of
from millrace.functions.htmltext import Line, Policy, links, prose, render, repair_bytes, section, strip_boilerplate

#: Headings of each platform, in the order in which they are tried.
RESPONSIBILITIES = {
    "successfactors": [r"Responsibilities\s+may\s+include", r"Key\s+Roles?\s+and\s+Responsibilities", r"Key\s+Responsibilities", r"Role\s+Responsibilities", r"Primary\s+Responsibilities", r"Typical\s+duties\s+include[^:]*", r"Responsibilities", r"What\s+You.ll\s+Do", r"The\s+Impact\s+You.ll\s+Make", r"Position\s+Description", r"Job\s+Description"],
    "oracle": [r"Responsibilities\s+include", r"Specific\s+responsibilities\s+(?:could|may|will)\s+include", r"Key\s+Responsibilities", r"responsibilities\s+of\s+a\s+[^:]+\s+in\s+this\s+role\s+include", r"you\s+will\s+be\s+responsible\s+for", r"About\s+the\s+job"],
    "talentbrew": [r"What\s+You.ll\s+Be\s+Doing", r"The\s+Impact\s+You\s+Will\s+Have"],
    "boeing": [r"Position\s+Responsibilities", r"Summary(?!\s+Pay)"],
    "dayforce": [r"Responsibilities"],
    "icims": [r"The\s+Role", r"Key\s+Responsibilities", r"Responsibilities"],
    "workday": [r"What\s+You.ll\s+Do", r"Key\s+Responsibilities", r"Responsibilities", r"Job\s+Responsibilities"],
}
REQUIRED = {
    "successfactors": [r"Required\s+Qualifications", r"Minimum\s+Qualifications", r"Basic\s+Qualifications", r"Essential\s+Qualifications", r"Required\s+Education\s*(?:&|and)\s*Experience", r"Technical\s+Knowledge/Skills/Abilities\s+Required", r"Who\s+We.re\s+Looking\s+For", r"Requirements", r"Qualifications"],
    "oracle": [r"Minimum\s+requirements"],
    "talentbrew": [r"What\s+You.ll\s+Need"],
    "boeing": [r"Basic\s+Qualifications\s*(?:\([^)]*\))?"],
    "dayforce": [r"Required\s+Qualifications?"],
    "icims": [r"Academic\s+Credentials", r"Minimum\s+Qualifications", r"Qualifications"],
    "workday": [r"Minimum\s+Qualifications", r"Required\s+Qualifications", r"Qualifications"],
}
PREFERRED = {
    "successfactors": [r"Preferred\s+Qualifications", r"Preferred\s+Skills", r"Nice\s+to\s+Have", r"Desired\s+(?:Qualifications|Experiences?)", r"Technical\s+Skills\s*[-–]\s*Desired"],
    "oracle": [r"Preferred\s+Qualifications"],
    "boeing": [r"Preferred\s+Qualifications\s*(?:\([^)]*\))?"],
    "dayforce": [r"Preferred\s+Qualifications?"],
    "icims": [r"Preferred\s+Experience", r"Preferred\s+Qualifications"],
    "workday": [r"Preferred\s+Qualifications", r"Nice\s+to\s+Have"],
}
#: What makes a line one about education; the platforms differ on purpose.
EDUCATION = {
    "talentbrew": r"(?i:\bbachelor|\bmaster(?!ing)|\bassociate(?!d)|ph\.?d|\bdegree\b|\bdiploma\b|high\s+school|\bGED\b|education|technical\s+school)|\bB\.?S\.?\b|\bM\.?S\.?\b|\bB\.?A\.?\b|\bM\.?A\.?\b",
    "boeing": r"(?i:\bbachelor|\bmaster(?!ing)|\bassociate'?s?\s+degree|ph\.?d|\bdegree(?!\s+of)\b|college|technical\s+school)|\bB\.Sc?\.?\b|\bM\.Sc?\.?\b|\bB\.A\.?\b|\bM\.A\.?\b|\bBS[A-Z]{2,4}\b|\bMS[A-Z]{2,4}\b",
    "successfactors": r"(?i:\bbachelor|\bmaster(?!ing)|\bassociate(?!d)|ph\.?d|\bdegree\b|\bdiploma\b|high\s+school|\bGED\b|college|technical\s+school)|\bB\.?S\.?\b|\bM\.?S\.?\b",
    "dayforce": r"^(?i:High\s+School|GED|B\.S\.|B\.A\.|M\.S\.|BS(?!\w)|MS(?!\w)|Ph\.?D|Bachelor|Master|Associate)",
}
BOTH = r"(?i)required.*education|degree\s+type|education.*degree"
YEARS = r"(?i)\byears?\b.*\b(?:experience|professional)\b|\bexperience\b.*\byears?\b|\bminimum\b.*\byears?\b"
POLICIES = {"dayforce": Policy(least=1, bullets_first=False), "boeing": Policy(least=1, bullets_first=False, stop=r"^[A-Z][\w ]{2,40}:\s*$"), "talentbrew": Policy(least=3), "workday": Policy(least=3, last=True), "icims": Policy(least=3, drop=r"(?i)^apply now|^#LI-"), "oracle": Policy(least=3), "successfactors": Policy(least=4)}
PAY = [r"\$[0-9,]+(?:\.[0-9]{2})?\s*(?:[-–]|to|and)\s*\$?[0-9,]+(?:\.[0-9]{2})?", r"\$[0-9,]+(?:\.[0-9]{2})?\+"]
BOILERPLATE = [("all", r"(?is)equal opportunity employer.*\Z"), ("first", r"(?is)about us\b.{0,2000}?(?=about the job|responsibilities)"), ("first", r"(?is)\bclick here to apply.*\Z"), ("all", r"#LI-\w+")]
#: Headings of this platform are read by their form; a short paragraph above a list is one too.
SF_RULES = Rules(forms=(HEADS, ("bold", "lead"), ANY), otherwise=("heading", "bold", "titled list"), bullets=True, least=4)
#: The section that a platform names its pay in.
PAY_SECTION = {"boeing": [r"Summary\s+Pay\s+Range"], "talentbrew": [r"Rewards\s+and\s+Benefits"]}
#: Where the store takes pay from nowhere else.
PAY_ONLY_THERE = {"talentbrew"}
#: Platforms whose fields are read from the lines of a page, by a cascade or a sectioner of their own.
BY_LINES = {"workday", "icims", "dayforce"}
FIELDS = ["job_responsibilities", "min_education", "min_experience", "preferred_qualifications", "salary_range", "error"]
RECORD = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])
LINE = T.StructType([T.StructField("text", T.StringType()), T.StructField("bullet", T.BooleanType()), T.StructField("heading", T.BooleanType()), T.StructField("form", T.StringType()), T.StructField("lead", T.StringType()), T.StructField("block", T.IntegerType())])
LINES = T.ArrayType(T.StringType())
LINKS = T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("title", T.StringType())]))


def split_required(platform: str, lines: list[str]) -> tuple[list[str], list[str]]:
    """Education and experience lines of a requirements block."""
    if platform == "oracle":
        return lines, []
    pattern = EDUCATION.get(platform, EDUCATION["successfactors"])
    if platform == "dayforce":
        labelled = [i for i, x in enumerate(lines) if re.match(r"(?i)Education:\s+", x)]
        first = next(iter(labelled), next((i for i, x in enumerate(lines) if re.search(pattern, x)), None))
        education = [] if first is None else [re.sub(r"(?i)^Education:\s+", "", lines[first])]
        return education, [x for i, x in enumerate(lines) if i != first]
    education = [x for x in lines if re.search(pattern, x)]
    if platform == "talentbrew":
        both = [x for x in education if re.search(YEARS, x)]
        schooling = [x for x in both if re.search(BOTH, x)]
        education = [x for x in education if x not in both] + schooling
        years = [x for x in lines if re.search(YEARS, x) and not re.search(pattern, x)] + [x for x in both if x not in schooling]
        return education, years + [x for x in lines if not re.search(pattern, x) and not re.search(YEARS, x)]
    return education, [x for x in lines if not re.search(pattern, x)]


def or_split(lines: list[str]) -> tuple[str, str] | None:
    parts = re.split(r"\s+-\s+OR\s+-\s+", lines[0]) if lines else []
    return (parts[0], parts[1]) if len(parts) == 2 else None


def detail(platform: str, html: str | None, pay_anywhere: bool = True) -> tuple:
    lines = render(strip_boilerplate(html or "", BOILERPLATE))
    policy = POLICIES.get(platform, Policy())

    def find(patterns: list[str]) -> list[str] | None:
        return section_of(lines, patterns, SF_RULES) if platform == "successfactors" else section(lines, patterns, policy)

    duties = find(RESPONSIBILITIES.get(platform, RESPONSIBILITIES["workday"]))
    if platform == "talentbrew":  # both sections count
        duties = [x for p in RESPONSIBILITIES[platform] for x in find([p]) or []]
    elif platform == "boeing":
        duties = [x for p in reversed(RESPONSIBILITIES[platform]) for x in find([p]) or []]
    duty_text = "\n".join(duties) if duties else prose(lines, r"(?i)^(?:job description|overview)\s*:?", r"(?i)cookie|copyright|all rights reserved") if platform in ("oracle", "successfactors") else None
    required = find(REQUIRED.get(platform, REQUIRED["workday"])) or []
    pair = or_split(required) if platform == "successfactors" else None
    education, experience = ([pair[0]], [pair[1], *required[1:]]) if pair else split_required(platform, required)
    preferred = find(PREFERRED.get(platform, []))
    named = "\n".join(find(PAY_SECTION.get(platform, [])) or [])
    # the section on pay goes before the rest of the page
    texts = (named, "\n".join(x.text for x in lines) if pay_anywhere else "")
    pay = next((m[0] for t in texts for p in PAY if (m := re.search(p, t))), None)
    return duty_text, "\n".join(education) or None, "\n".join(experience) or None, "\n".join(preferred) if preferred else None, pay, None


@F.pandas_udf(RECORD)
def detail_record(platform: pd.Series, html: pd.Series) -> pd.DataFrame:
    rows = []
    for p, h in zip(platform, html, strict=True):
        try:
            rows.append(detail(p, h))
        except Exception as e:  # noqa: BLE001  one bad page is a row with an error
            rows.append((None, None, None, None, None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(rows, columns=FIELDS)


@F.pandas_udf(T.StructType([T.StructField("r", RECORD), T.StructField("lines", T.ArrayType(LINE))]))
def page_record(platform: pd.Series, html: pd.Series) -> pd.DataFrame:
    """One parse of a page: `lines` where the platform's fields are read from them, else the record `r`."""
    rows = []
    for p, h in zip(platform, html, strict=True):
        try:
            rows.append((None, [vars(x) for x in render(h)]) if p in BY_LINES else (dict(zip(FIELDS, detail(p, h, p not in PAY_ONLY_THERE), strict=True)), None))
        except Exception as e:  # noqa: BLE001  one bad page is a row with an error
            rows.append((dict.fromkeys(FIELDS[:-1]) | {"error": f"{type(e).__name__}: {e}"}, None))
    return pd.DataFrame(rows, columns=["r", "lines"], dtype=object)


@F.pandas_udf(T.ArrayType(LINE))
def line_records(html: pd.Series) -> pd.Series:
    """A page as lines that know their form: one parse for all fields."""
    return html.map(lambda h: [vars(x) for x in render(h)])


def located_sections(lines: Column, groups: dict[str, tuple[list[str], Rules]], intro: tuple[list[str], str] | None = None) -> Column:
    """struct of the groups' sections, each an array of lines or null, and `intro`: all of a page's sections in one
    pass over its lines. groups: headings and rules by name; intro: first lines of a summary, and what ends it."""
    kind = T.StructType([*[T.StructField(name, LINES) for name in groups], T.StructField("intro", T.StringType())])

    @F.pandas_udf(kind)
    def find(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            own = [] if page is None else [Line(*[x[c] for c in LINE.names]) for x in page]
            rows.append([*[section_of(own, patterns, rules) for patterns, rules in groups.values()], intro_of(own, *intro) if intro else None])
        return pd.DataFrame(rows, columns=[*groups, "intro"], dtype=object)

    return find(lines)


@F.pandas_udf(LINKS)
def link_list(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [{"href": a, "title": t} for a, t in links(h, "href")])


@F.pandas_udf(LINES)
def rendered_lines(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [x.text for x in render(h)])


@F.pandas_udf(LINES)
def list_items(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [x.text for x in render(h) if x.bullet])


@F.pandas_udf(T.StringType())
def prose_text(html: pd.Series) -> pd.Series:
    return html.map(lambda h: prose(render(h), r"(?i)^(?:overview)\s*:?", r"(?i)cookie|copyright"))


@F.pandas_udf(T.StringType())
def stripped(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else strip_boilerplate(t, BOILERPLATE))


@F.pandas_udf(LINES)
def section_lines(html: pd.Series) -> pd.Series:
    """Bullets below the first heading about duties."""
    return html.map(lambda h: section(render(h), [r"Duties", *RESPONSIBILITIES["workday"]], Policy()))


@F.pandas_udf(T.StringType())
def repaired(raw: pd.Series) -> pd.Series:
    return raw.map(lambda b: None if b is None else repair_bytes(b))


@F.pandas_udf(LINES)
def jsonld_blocks(html: pd.Series) -> pd.Series:
    block = re.compile(r"<script[^>]*application/ld\+json[^>]*>(.*?)</script>", re.S | re.I)
    return html.map(lambda h: block.findall(h or ""))


def first_jsonld(html: Column, kind: str = "JobPosting") -> Column:
    """The first JSON-LD block of a type."""
    return F.get(F.filter(jsonld_blocks(html), lambda x: F.get_json_object(x, "$.@type") == kind), 0)
