"""From captured payloads to the posting store: all companies in one job.

payloads: platform, company_name, url, title, location, body, as_of. Each platform keeps its own rule
for locations; details of all platforms are read in one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import icims_pay, labelled_pay, parse_date, salary, sanitize, strip_tags
from millrace.operators.cascades import icims_details, workday_details
from millrace.operators.dayforce import dayforce_details
from millrace.operators.details import BY_LINES, page_record
from millrace.operators.store import evolve, least_by, upsert
from millrace.sources.captured import script_json
from millrace.sources.workspace import written

#: How each platform tells a place in the United States, and whether no place passes.
STATES = "Alabama|Alaska|Arizona|Arkansas|California|Colorado|Connecticut|Delaware|Florida|Georgia|Hawaii|Idaho|Illinois|Indiana|Iowa|Kansas|Kentucky|Louisiana|Maine|Maryland|Massachusetts|Michigan|Minnesota|Mississippi|Missouri|Montana|Nebraska|Nevada|New Hampshire|New Jersey|New Mexico|New York|North Carolina|North Dakota|Ohio|Oklahoma|Oregon|Pennsylvania|Rhode Island|South Carolina|South Dakota|Tennessee|Texas|Utah|Vermont|Virginia|Washington|West Virginia|Wisconsin|Wyoming"
CODES = "AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|MA|MI|MN|MS|MO|MT|NE|NV|NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|TX|UT|VT|VA|WA|WV|WI|WY"
PATH_PLACE = rf"/job/[^/]*-(?:{CODES}|DC)(?:/|---|$|-[^A-Z]|-[A-Z][a-z])"
PLACE_RULES = {
    "boeing": (STATES, False),
    "talentbrew": (rf",\s*(?:{STATES})\b|United States", True),
    "icims": (r"(?i)United States", False),
}
#: The one company of its platform whose listing holds places abroad.
CODED_COMPANY = "TSMC"


def in_country(platform: Column, location: Column, company: Column, path: Column, filters: Column | None = None) -> Column:
    """Whether a posting is one in the United States by its platform's own rule.

    filters is listing_filters() of the careers URL (with country_facet added where the listing told one).
    For workday a short search text is a state, named states are looked for, and only where there is no
    facet, state or search the path or the end of the location has to name a state. Platforms without a
    rule keep all rows: their listings are filtered where they are read.
    """
    out = F.lit(True)
    for name, (pattern, keep_null) in PLACE_RULES.items():
        out = F.when(platform == name, F.coalesce(location.rlike(pattern), F.lit(keep_null))).otherwise(out)
    coded = F.coalesce(location.rlike(rf"\b(?:{CODES})\b|United States"), F.lit(True))
    out = F.when((platform == "successfactors") & (company == CODED_COMPANY), coded).otherwise(out)
    by_path = location.isNull() | location.rlike(rf",\s*(?:{CODES}|DC)\s*$") | F.coalesce(path.rlike(PATH_PLACE), F.lit(False))
    if filters is None:
        return F.when(platform == "workday", by_path).otherwise(out)
    state = F.when(filters["q"].rlike("^[A-Z]{2,3}$"), F.coalesce(F.contains(location, F.concat(F.lit("US-"), filters["q"])), F.lit(True))).otherwise(True)
    low = F.lower(location)
    named = F.when(F.size(filters["states"]) > 0, location.isNull() | F.exists(filters["states"], lambda s: F.contains(low, F.lower(s)))).otherwise(True)
    free = (F.length(filters["q"]) == 0) & (F.size(filters["states"]) == 0) & ~F.coalesce(filters["country_facet"], F.lit(False))
    return F.when(platform == "workday", state & named & (~free | by_path)).otherwise(out)


DETAILS = ["job_responsibilities", "min_education", "min_experience", "preferred_qualifications", "salary_range", "essential_skills"]
#: What a payload itself may carry besides.
CARRIED = ["job_identification", "job_category", "degree_level", "ecl_gtc_required"]
#: What a posting that comes again sets, null or not; details that it lacks stay.
OVERWRITE = ["job_title", "location", "posting_date", *CARRIED]
KEEP = DETAILS
#: What the listing of a payload looked for: listing_filters() of its URL, and whether it had a country facet.
FILTERS = "struct<q:string,states:array<string>,country_facet:boolean>"


#: The configuration that pages of one platform carry, and how deep its fields lie in it.
CONFIG, JOB = r"window\.jobDescriptionConfig", "$.job."
#: The label of one platform's pay, in a heading or a span.
PAY_LABEL, PAY_NODES = "Base Salary Range", r"(?is)<(h3|span)\b[^>]*>(.*?)</\1>"


def _pay(platform: Column, text: Column, body: Column, least: Column, most: Column, record: Column) -> Column:
    """Pay by the platform's own rule. text: the page's lines; least, most: target tags; record: what its section gave."""
    labels = F.transform(F.regexp_extract_all(body, F.lit(PAY_NODES), F.lit(2)), strip_tags)
    return F.when(platform.isin("workday", "dayforce"), salary(text)).when(platform == "icims", icims_pay(least, most, body)).when(platform == "talentbrew", labelled_pay(labels, PAY_LABEL, record)).otherwise(record)


def postings(payloads: DataFrame) -> DataFrame:
    """One row for each listed posting, in listing order `ord` of its URL.

    Payloads are read and their pages parsed once, and what that gives is written, so that the platforms whose fields
    come from lines (two cascades and the sectioner of plain headings) read only their own columns of it. Pay follows
    each platform's own rule. Where a page carries a configuration, its description is the body, and it gives the
    category that the payload lacks. Fields that a payload lacks are null; `filters` (FILTERS) says what its listing
    looked for, and one without it looked for nothing. A null body, or one that cannot be read, gives null fields.
    """
    rows = evolve(payloads, dict.fromkeys(CARRIED, "string") | {"filters": FILTERS})
    nothing = F.struct(F.lit("").alias("q"), F.array().cast("array<string>").alias("states"), F.lit(False).alias("country_facet"))
    rows = rows.withColumn("filters", F.struct(*[F.coalesce(F.col("filters")[c], nothing[c]).alias(c) for c in ("q", "states", "country_facet")]))
    rows = rows.filter(in_country(F.col("platform"), F.col("location"), F.col("company_name"), F.col("url"), F.col("filters")))
    config = F.when(F.col("platform") == "icims", script_json(F.col("body"), CONFIG))
    value = lambda name: F.get_json_object("config", JOB + name)
    rows = rows.withColumn("config", config).withColumn("body", F.coalesce(value("description"), "body"))
    category = F.array_join(F.transform(F.from_json(value("category"), F.lit("array<string>")), F.trim), ", ")
    rows = rows.withColumn("job_category", F.coalesce("job_category", category)).withColumn("page", page_record("platform", "body"))
    common = ["platform", "company_name", F.col("url").alias("job_url"), "ord", F.col("title").alias("job_title"), "location", parse_date(F.col("posted"), F.col("as_of")).alias("posting_date"), *CARRIED]
    text = F.array_join(F.transform("page.lines", lambda x: x["text"]), "\n")
    pay = _pay(F.col("platform"), text, F.col("body"), value("tags5[0]"), value("tags6[0]"), F.col("page.r.salary_range"))
    # the order of its rows by platform lets a branch pass over the row groups of others
    parsed = written(rows.select(*common, F.col("page.r").alias("r"), pay.alias("salary_range"), F.col("page.lines").alias("lines")).sortWithinPartitions("platform"), "parsed")
    kept = [c for c in parsed.columns if c not in ("platform", "r", "lines")]
    none = F.lit(None).cast("string").alias("essential_skills")
    by_record = [c for c in DETAILS if c not in ("salary_range", "essential_skills")]
    parts = [parsed.filter(F.coalesce(~F.col("platform").isin(*BY_LINES), F.lit(True))).select(*kept, *[F.col(f"r.{c}") for c in by_record], none)]
    plain = lambda df: dayforce_details(df.withColumn("lines", F.transform("lines", lambda x: x["text"]))).withColumn("essential_skills", F.lit(None).cast("string"))
    for platform, read in (("workday", workday_details), ("icims", icims_details), ("dayforce", plain)):
        parts.append(read(parsed.filter(F.col("platform") == platform).select(*kept, "lines")).drop("lines"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def ingest(store: DataFrame, payloads: DataFrame) -> DataFrame:
    """The store after one batch of payloads; text is sanitised, and a URL keeps its first company. Columns that the
    store lacks are added."""
    new = postings(payloads)
    batch = new.withColumns({c: sanitize(F.col(c)) for c in ["job_title", "location", *CARRIED, *KEEP]})
    owner = least_by(new.select("job_url", "ord", F.col("company_name").alias("new_company")), ["job_url"], [F.col("ord")]).drop("ord")
    out = upsert(evolve(store, dict.fromkeys([*CARRIED, *KEEP], "string")), batch, "job_url", "ord", OVERWRITE, KEEP, {"company_name": F.lit(None).cast("string")})
    return out.join(owner, "job_url", "left").withColumn("company_name", F.coalesce("company_name", "new_company")).drop("new_company")


def latest_exports(rows: DataFrame) -> DataFrame:
    """Rows of each company's latest file; the alias of a company counts as the company, and of two files of a
    day the one whose path comes first. rows: slug, day, path."""
    slug = F.when(F.col("slug") == "nxp_semiconductors", "nxp").otherwise(F.col("slug"))
    named = rows.withColumn("slug", slug)
    files = named.groupBy("slug").agg(F.max("day").alias("last_day")).join(named.select("slug", "day", "path").distinct(), "slug").filter("day = last_day")
    last = files.groupBy("slug").agg(F.min("path").alias("of_path")).select(F.col("slug").alias("of_slug"), "of_path")
    return named.join(last, (F.col("slug") == F.col("of_slug")) & (F.col("path") == F.col("of_path"))).drop("of_slug", "of_path")
