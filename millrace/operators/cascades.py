"""Field cascades of the two platforms whose postings have no fixed sections.

A page is parsed once, into lines (details.line_records), and all its sections are found in one pass over them; all
else is DataFrame expressions over arrays of lines. A cascade is a table of steps in order: each fills a field only where the steps before left it null, or
adds to it. So a step reads as one row of the table, and its order is part of the result.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.forms import HEADS, Rules
from millrace.functions.lines import assemble, expand_bullets, joined, once, split_credentials, split_preferred
from millrace.functions.scalars import squish
from millrace.operators.details import located_sections

#: Headings of each field, in the order in which they are tried.
NEEDED = [r"Minimum\s+Qualifications", r"Min\s+Qualifications", r"Minimum\s+Requirements", r"Required\s+Qualifications", r"Required\s+Experience", r"Basic\s+Qualifications", r"Here.s\s+what\s+you.ll\s+need", r"Qualifications\s+You\s+Must\s+Have", r"Job\s+requirements", r"What\s+you\s+should\s+have", r"As\s+a\s+Minimum(?:,?\s+You\s+Will\s+Need)?", r"Requirements\s+and\s+Technical\s+Competency", r"How\s+to\s+Qualify", r"Required\s+Skills"]
COMBINED = [r"Job\s+Qualifications", r"Required\s+skills?\s+and\s+qualifications", r"Attributes", r"Your\s+Background", r"We\s+are\s+looking\s+for", r"Qualifications"]
WANTED = [r"Preferred\s+Qualifications", r"Preferred\s+Requirements", r"Preferred\s+Experience", r"Qualifications\s+We\s+Prefer", r"Preferred\s+Skills", r"What\s+Sets\s+You\s+Apart", r"Nice\s+to\s+Have", r"The\s+following\s+are\s+a\s+PLUS,?\s+but\s+not\s+required"]
DUTIES = [r"Key\s+Responsibilities", r"Primary\s+Responsibilities", r"Role\s+and\s+Responsibilities", r"Job\s+Responsibilities", r"What\s+You.ll\s+Do", r"What\s+You\s+Will\s+Do", r"Responsibilities", r"Duties\s+of\s+the\s+job", r"Here.s\s+What\s+You.ll\s+Be\s+Responsible\s+For"]
MORE_DUTIES = [r"Position\s+Summary", r"Role\s+Overview", r"About\s+the\s+role", r"Job\s+Summary"]
SINGLE = [r"Education(?:\s+and\s+Skills)?", r"Required\s+Education", r"Experience(?:\s+(?:Required|and\s+education))?", r"Functional\s+Knowledge", r"Business\s+Expertise", r"Other\s+Requirements", r"The\s+Person"]
SKILLS = ["Leadership", "Problem Solving", "Impact", "Interpersonal Skills", "Physical Requirements"]
INTRO = [r"^As an? ", r"^We are (?:looking|seeking) ", r"^NXP is (?:looking|seeking) ", r"^We\s+seek ", r"^In this role", r"^This position ", r"^The .+ (?:is responsible|will be responsible|team is)", r"^Northrop Grumman (?:Corporation )?is (?:looking|seeking) "]
EDUCATION = r"(?i:\bbachelor|\bmaster(?!ing)|\bassociate(?!d)|ph\.?d|\bdegree\b|\bdiploma\b|high\s+school|\bGED\b|college|technical\s+school|education\s+requirement)|\bB\.?S\.?\b|\bM\.?S\.?\b|\bB\.?A\.?\b|\bM\.?A\.?\b|\bA\.?A\.?S?\.?\b|\bA\.?S\.\b|\b[BM]S(?:EE|CS|ME|CE|ECE|PE)\b"
NOTICE = r"(?i)^Fraud\s+alert:?\s+Micron|^As a worldwide provider of semiconductor|^Compensation for this role|^Regular full-time employees|benefits including Medical|^#LI-|^Life @ Samsung|^U\.S\.\s+Export Control|^Trade Secrets"
ICIMS_EDUCATION = r"(?i:\bbachelor|\bmaster(?!ing)|\bassociate'?s?\s+degree|ph\.?d|\bdegree(?!\s+of)\b|college|technical\s+school)|\bB\.Sc?\.?\b|\bM\.Sc?\.?\b|\bB\.A\.?\b|\bM\.A\.?\b|\bBS[A-Z]{2,4}\b|\bMS[A-Z]{2,4}\b|\bBSc\b|\bMSc\b|\b[BM]S(?!\s+(?:Office|Excel|Word|PowerPoint|Outlook|Teams|Azure|SQL|Access|Windows|Project|Visio|Copilot|Visual\s+Studio|Dynamics|SharePoint))\b"
ENROLLED = r"(?i)\benrolled\b.*college|college/university|accredited college|must be enrolled"
LABEL = r"(?i)^(?:Required|Desired|Preferred|Musts?|Qualities|Skills?)\s*:?$|^[A-Za-z &/]{2,40}:\s*$|^pay\s+range|^USD\s+\$|^\$[0-9,]+.*(?:Year|Hourly)|Visa Sponsorship is not available|sponsorship for employment visa"
FIELDS = ["job_responsibilities", "min_education", "min_experience", "preferred_qualifications", "essential_skills"]


#: Further headings, which only end a section; those of the other platform; and what none of its
#: sections holds.
OTHER_HEADINGS = [r"Job\s+Description", r"Education\s+Requirements", r"What.s\s+Encouraged\s+Daily", r"Additional\s+Information", r"Key\s+Challenges", r"What\s+you\s+bring", r"Functional\s+(?:&|and)\s+Business\s+Expertise", r"Impact\s+(?:&|and)\s+Interpersonal\s+Skills", r"Objectives", r"Skills\s+and\s+Qualifications", r"Total\s+Rewards", r"Core\s+competencies", r"Competencies\s+and\s+Skills", r"Technical\s+Proficiencies", r"Purpose", r"Salary\s+Range", r"Working\s+Conditions", r"Work\s+Shift", r"Required\s+Materials", r"What\s+We\s+Offer", r"The\s+ideal\s+candidate\s+should\s+demonstrate", r"Benefits\s+at\s+Intel", r"Additional\s+Qualifications", r"Business\s+Line", r"What\s+You\s+will\s+Drive"]
ICIMS_HEADINGS = ["THE ROLE", "THE PERSON", "KEY RESPONSIBILITIES", "PREFERRED EXPERIENCE", "ACADEMIC CREDENTIALS", "PREFERRED QUALIFICATIONS", "REQUIRED QUALIFICATIONS", "JOB DESCRIPTION", "JOB QUALIFICATIONS", "EDUCATION REQUIREMENTS", "LOCATION", "JOB SUMMARY", "WHAT WE NEED TO SEE", "WAYS TO STAND OUT FROM THE CROWD", "WHAT YOU.LL BE DOING", "WHAT YOU.LL DO"]
ICIMS_NOTICE = r"(?i)This role is not|not eligible for visa sponsorship|AMD is committed|AMD does not accept|it is our policy to provide|Benefits offered|Keysight is an Equal Opportunity|Careers Privacy Statement|US Employees may be eligible|This role is eligible for Keysight Results Bonus|Pay Range.*(?:MIN|MAX|USD|\$)|USD\s+\$[0-9]|requires access to technology.*export control|U\.S\. citizen.*export control|export control.*U\.S\. Government|level of role will be based on applicable experience|Salary Range listed below|Visa Sponsorship is not available|sponsorship for employment visa"
INTRO_STOP = r"Key |Role |General |Minimum |Preferred |Functional |Business |Physical |Primary |Job |Qualifications|Attributes|Required |Responsibilities|Description|What you|What's |Position Summary|Skills and Qualifications|Here.s What|Here.s what|We are looking|Duties of|How to Qualify|The following are a PLUS|The ideal candidate|Benefits at Intel"

#: The last place of a heading counts, since earlier ones are in explanations; list items never end a section.
KNOWN = "|".join([*NEEDED, *COMBINED, *WANTED, *DUTIES, *MORE_DUTIES, *SINGLE, *OTHER_HEADINGS])
WORKDAY_RULES = Rules(otherwise=("heading", "bold", "known"), last=True, known=KNOWN, least=6)
#: Qualifications have bold labels of their own, so only known headings end them.
WORKDAY_LABELLED = replace(WORKDAY_RULES, otherwise=("known",))
WORKDAY_MARKED = replace(WORKDAY_RULES, forms=((*HEADS, "bold"),))
ICIMS_RULES = Rules(forms=(("h2",), ("h3",), ("bold", "lead"), ("p", "text")), stops=(("h2", ("h2",)), ("h3", ("h3", "h2")), ("bold", ("bold", "known")), ("lead", ("bold", "known"))), otherwise=("known", "h2"), known="|".join(x.replace(" ", r"\s+") for x in ICIMS_HEADINGS), drop=ICIMS_NOTICE, cut=True, least=4, loose=True)

#: The sections that each cascade reads, by name.
WORKDAY_SECTIONS = {
    "needed": (NEEDED, WORKDAY_LABELLED),
    "education_and_skills": ([r"Education\s+and\s+Skills"], WORKDAY_RULES),
    "experience": (["Experience"], WORKDAY_RULES),
    "combined": (COMBINED, WORKDAY_LABELLED),
    "education": (["Education"], WORKDAY_RULES),
    "required_education": ([r"Required\s+Education"], WORKDAY_RULES),
    "expertise": ([r"Functional\s+(?:&|and)\s+Business\s+Expertise"], WORKDAY_RULES),
    "experience_required": ([r"Experience\s+Required"], WORKDAY_RULES),
    "functional": ([r"Functional\s+Knowledge"], WORKDAY_RULES),
    "business": ([r"Business\s+Expertise"], WORKDAY_RULES),
    "other": ([r"Other\s+Requirements"], WORKDAY_RULES),
    "experience_and_education": ([r"Experience\s+and\s+education"], WORKDAY_RULES),
    "position_requires": ([r"Position\s+requires"], WORKDAY_RULES),
    "wanted": (WANTED, WORKDAY_LABELLED),
    "more_duties": (MORE_DUTIES, WORKDAY_RULES),
    "duties": (DUTIES, WORKDAY_RULES),
    **{name: ([name.replace(" ", r"\s+")], WORKDAY_MARKED) for name in SKILLS},
}
ICIMS_SECTIONS = {
    name: (patterns, ICIMS_RULES)
    for name, patterns in {
        "summary": [r"Job\s+Summary"],
        "role": [r"The\s+Role"],
        "duties": [r"Key\s+Responsibilities", "Responsibilities"],
        "doing": [r"What\s+You.ll\s+Do", r"What\s+You.ll\s+Be\s+Doing", r"Job\s+Description"],
        "credentials": [r"Education\s+Requirements", r"Academic\s+Credentials", "Education", r"Education\s+(?:&|and)\s+Experience", r"Required\s+Education"],
        "minimum": [r"Minimum\s+Qualifications", r"Minimum\s+Experience", r"Required\s+Qualifications", r"Requirements", r"Required\s+Experience"],
        "wished": [r"Preferred\s+Experience"],
        "preferred": [r"Preferred\s+Qualifications", r"Preferred\s+Skills"],
        "person": [r"The\s+Person"],
        "qualifications": ["Qualifications"],
        "desired": [r"Desired\s+Qualifications"],
        "experience": ["Experience"],
    }.items()
}


def section(lines: Column, patterns: list[str], rules: Rules = WORKDAY_RULES) -> Column:
    """Lines under a heading by a platform's rules; null without any. lines: details.line_records."""
    return located_sections(lines, {"found": (patterns, rules)})["found"]


def role_summary(lines: Column) -> Column:
    """The first paragraph that introduces the role, over 30 characters, up to a line that looks like a heading."""
    return located_sections(lines, {}, (INTRO, INTRO_STOP))["intro"]


def essential_skills(found: Column) -> Column:
    """`Heading: text` for each skill that stands as a marked heading."""
    return joined(F.array_compact(F.array(*[F.concat(F.lit(f"{name}: "), joined(found[name], " ")) for name in SKILLS])))


def _with(lines: Column, pattern: str) -> Column:
    return F.filter(lines, lambda x: x.rlike(pattern))


def _without(lines: Column, pattern: str) -> Column:
    return F.filter(lines, lambda x: ~x.rlike(pattern))


def _added(old: str, new: Column) -> Column:
    return F.concat_ws("\n", F.col(old), new)


def _null_if_empty(text: Column) -> Column:
    return F.when(F.length(text) > 0, text)


def workday_details(df: DataFrame, lines_col: str = "lines") -> DataFrame:
    """df with FIELDS, from a column of lines."""
    df = df.select(F.struct(*df.columns).alias("own"), F.col(lines_col).alias("lines")).withColumn("found", located_sections(F.col("lines"), WORKDAY_SECTIONS, (INTRO, INTRO_STOP)))
    lines, found = F.col("lines"), F.col("found")
    no_edu, no_exp = F.col("min_education").isNull(), F.col("min_experience").isNull()
    neither = no_edu & no_exp

    # 1 the requirements of their own section, one education line split from what is only preferred
    out = df.withColumn("s", _without(expand_bullets(found["needed"]), NOTICE)).withColumn("s", split_preferred(F.transform("s", lambda x: F.regexp_replace(x, r"(?i)^(?:Experience\s*(?:&|and)\s*Education|Education\s*(?:&|and)\s*Experience)\s*:?\s*", "")), EDUCATION))
    out = out.withColumns({"min_education": joined(_with(F.col("s.kept"), EDUCATION)), "min_experience": joined(_without(F.col("s.kept"), EDUCATION)), "moved": F.col("s.preferred")})
    # 2 education and skills in one section: what is no degree belongs to the duties
    out = out.withColumn("s", F.when(neither, found["education_and_skills"])).withColumns({"e": joined(_with(F.col("s"), EDUCATION)), "r": joined(_without(F.col("s"), EDUCATION))})
    out = out.withColumns({"min_education": F.coalesce("min_education", "e"), "min_experience": F.coalesce("min_experience", F.when(F.col("e").isNull(), F.col("r"))), "tools": F.when(F.col("e").isNotNull() & (F.length("r") > 20), F.col("r"))})
    # 3 a section on experience alone
    out = out.withColumn("min_experience", F.coalesce("min_experience", joined(found["experience"], " ")))
    # 4 a combined section, notices left out
    out = out.withColumn("s", F.when(neither, F.filter(F.transform(_without(found["combined"], NOTICE), lambda x: squish(F.regexp_replace(x, r"(?i)\s*(?:Compensation for this role|Regular full-time employees|#LI-).*$", ""))), lambda x: F.length(x) > 0)))
    out = out.withColumns({"e": joined(_with(F.col("s"), r"(?i)^Education\s*:|" + EDUCATION)), "r": joined(_without(F.col("s"), r"(?i)^Education\s*:|" + EDUCATION))}).withColumns({"min_education": F.coalesce("min_education", "e"), "min_experience": F.coalesce("min_experience", "r")})
    # 5 single headings, each for one field
    for name in ("education", "required_education"):
        out = out.withColumn("min_education", F.coalesce("min_education", F.when(no_edu, joined(found[name], " "))))
    out = out.withColumn("min_experience", F.coalesce("min_experience", F.when(no_exp, joined(found["expertise"], " "))))
    # 6 headings that add to the experience
    for name in ("experience_required", "functional", "business", "other"):
        out = out.withColumn("min_experience", _null_if_empty(_added("min_experience", joined(found[name], " "))))
    # 7 experience and education in one: the first degree, or else the first line
    out = out.withColumn("s", F.when(no_edu, found["experience_and_education"])).withColumn("e", F.coalesce(F.get(_with(F.col("s"), EDUCATION), 0), F.get("s", 0)))
    out = out.withColumns({"min_education": F.coalesce("min_education", "e"), "min_experience": F.coalesce("min_experience", F.when(F.col("e").isNotNull(), joined(F.array_except("s", F.array("e")))))})
    # 8 postings of immigration filings: sentences without headings
    texts = F.transform(lines, lambda x: squish(x["text"]))
    accepted = F.get(_with(texts, r"(?i)^Employer\s+will\s+accept\s+a\s+"), 0)
    out = out.withColumn("min_education", F.coalesce("min_education", accepted))
    least = F.regexp_replace(F.get(F.filter(texts, lambda x: x.rlike(r"(?i)^Minimum\s+") & x.rlike(EDUCATION)), 0), r"(?i)^Minimum\s+", "")
    tail = r",?\s+and\s+(\d.+)$"
    out = out.withColumn("e", F.when(no_edu, least)).withColumns({"min_education": F.coalesce("min_education", F.regexp_replace("e", tail, "")), "min_experience": F.coalesce("min_experience", F.when(F.col("e").rlike(tail), F.regexp_extract("e", tail, 1)))})
    required = F.transform(found["position_requires"], lambda x: F.regexp_replace(x, r"^\d+\.\s*", ""))
    out = out.withColumn("min_experience", F.coalesce("min_experience", joined(required)))
    # 9 what is preferred, and an education line from there where there is none
    out = out.withColumn("s", F.concat(F.coalesce("moved", F.array().cast("array<string>")), F.coalesce(found["wanted"], F.array().cast("array<string>"))))
    out = out.withColumn("e", F.when(no_edu, F.get(_with(F.col("s"), EDUCATION), 0))).withColumns({"min_education": F.coalesce("min_education", "e"), "preferred_qualifications": joined(F.when(F.col("e").isNotNull(), F.array_except("s", F.array("e"))).otherwise(F.col("s")))})
    # 10 duties from the summary, further sections and the list of duties
    parts = F.array_compact(F.array(joined(found["more_duties"]), joined(found["duties"])))
    out = out.withColumn("job_responsibilities", _null_if_empty(F.concat_ws("\n\n", assemble(found["intro"], parts), F.col("tools"))))
    return out.withColumn("essential_skills", essential_skills(found)).select("own.*", *FIELDS)


def icims_details(df: DataFrame, lines_col: str = "lines") -> DataFrame:
    """df with FIELDS, from a column of lines. Where a field goes depends on which others there are."""
    df = df.select(F.struct(*df.columns).alias("own"), located_sections(F.col(lines_col), ICIMS_SECTIONS).alias("found"))
    found = F.col("found")
    none = F.lit(None).cast("string")
    duties = F.array_compact(F.array(*[joined(found[name]) for name in ("summary", "role", "duties")]))
    other = joined(found["doing"])
    out = df.withColumn("job_responsibilities", F.coalesce(joined(duties), other))
    # 1 credentials, of which one may be marked as preferred
    raw = joined(found["credentials"])
    out = out.withColumn("s", split_credentials(raw)).withColumns({"min_education": F.col("s.education"), "credential": F.col("s.preferred")})
    out = out.withColumns({"min_experience": joined(found["minimum"]), "wished": joined(found["wished"]), "standard": joined(found["preferred"])})
    # 2 preferred experience is the requirement where there is no other and nothing else is preferred, or a credential is
    out = out.withColumn("taken", F.col("wished").isNotNull() & F.col("min_experience").isNull() & (F.col("credential").isNotNull() | F.col("standard").isNull()))
    out = out.withColumns({"min_experience": F.when(F.col("taken"), F.col("wished")).otherwise(F.col("min_experience")), "wished": F.when(~F.col("taken"), F.col("wished"))})
    # 3 a sentence on the ideal candidate among the duties
    ideal = F.regexp_substr("job_responsibilities", F.lit(r"(?i)The ideal candidate will (?:have|need)[^.]+\."))
    out = out.withColumn("min_experience", F.coalesce("min_experience", F.when(F.length(ideal) > 20, ideal)))
    # 4 education lines out of the requirements, then the person
    out = out.withColumn("s", F.when(F.col("min_education").isNull(), F.split("min_experience", "\n"))).withColumn("e", joined(_with(F.col("s"), ICIMS_EDUCATION)))
    out = out.withColumns({"min_education": F.coalesce("min_education", "e"), "min_experience": F.when(F.col("e").isNotNull(), joined(_without(F.col("s"), ICIMS_EDUCATION))).otherwise(F.col("min_experience"))})
    out = out.withColumn("min_experience", _null_if_empty(_added("min_experience", joined(found["person"]))))
    # 5 one block of qualifications, with or without labels inside
    block = F.when(F.col("min_education").isNull() & F.col("min_experience").isNull(), found["qualifications"])
    wish = r"(?i)^(?:Desired|Preferred)(?:\s+Qualifications)?\s*:?$"
    out = out.withColumn("s", block).withColumn("at", F.array_position(F.transform("s", lambda x: x.rlike(wish)), True)).withColumn("from", F.array_position(F.transform("s", lambda x: x.rlike(r"(?i)^Required\s*:?$")), True))
    end = F.when(F.col("at") > F.col("from"), F.col("at") - 1).otherwise(F.size("s")).cast("int")
    out = out.withColumns({"req": _without(F.slice("s", (F.col("from") + 1).cast("int"), F.greatest(F.lit(0), (end - F.col("from")).cast("int"))), LABEL), "des": F.when(F.col("at") > 0, F.slice("s", (F.col("at") + 1).cast("int"), F.size("s")))})
    marked = _with(F.filter("req", lambda x: x.rlike(ICIMS_EDUCATION)), r"(?i)\bpreferred\b")
    held = F.filter("req", lambda x: x.rlike(ICIMS_EDUCATION) & ~x.rlike(r"(?i)\bpreferred\b") & ~x.rlike(ENROLLED))
    out = out.withColumns({"min_education": F.coalesce("min_education", joined(held)), "min_experience": F.coalesce("min_experience", joined(F.array_except("req", F.concat(marked, held)))), "standard": F.coalesce("standard", joined(_without(F.concat(marked, F.coalesce("des", F.array().cast("array<string>"))), r"(?i)^pay\s+range|^USD\s+\$|Salary Range listed below|export control")))})
    out = out.withColumn("standard", F.coalesce("standard", joined(found["desired"])))
    # 6 a section on experience tells itself what is required and what is preferred
    out = out.withColumn("s", found["experience"]).withColumn("req", _with(F.col("s"), r"(?i)\brequired\b"))
    out = out.withColumns({"min_education": _null_if_empty(_added("min_education", joined(_with(F.col("req"), ICIMS_EDUCATION)))), "min_experience": _null_if_empty(_added("min_experience", joined(_without(F.col("req"), ICIMS_EDUCATION)))), "standard": _null_if_empty(_added("standard", joined(_without(_with(F.col("s"), r"(?i)\bpreferred\b"), r"(?i)\brequired\b"))))})
    out = out.withColumn("preferred_qualifications", _null_if_empty(F.concat_ws("\n", "credential", "wished", "standard")))
    return out.withColumn("essential_skills", none).select("own.*", *FIELDS)
