"""Scalar functions of the education and job-posting data, as Column to Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def standardize_code(text: Column) -> Column:
    """`11070100 - Computer Science` to `11.0701`; null unless eight digits come before the dash."""
    digits = F.trim(F.regexp_replace(text, r" *-.*$", ""))
    return F.when(digits.rlike(r"^[0-9]{8}$"), F.concat(digits.substr(1, 2), F.lit("."), digits.substr(3, 4)))


def squish(text: Column) -> Column:
    """White space runs (also no-break spaces) become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def sanitize(text: Column) -> Column:
    """Control characters become spaces, then squish."""
    return squish(F.regexp_replace(F.replace(text, F.lit("\0"), F.lit("")), r"[\x01-\x1F\x7F]", " "))


def clean_text(text: Column, least: int = 3, most: int = 5000) -> Column:
    """Squished and cut to `most` characters; null if shorter than `least`."""
    out = squish(text)
    return F.when(F.length(out) >= least, F.substring(out, 1, most))


def slug(name: Column) -> Column:
    """Lower-case name with underscores between the words."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


#: The date formats in the order in which they are tried.
DATE_FORMATS = [(r"^\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"), (r"^\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"), (r"^\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"), (r"^[A-Za-z]+ \d{1,2}, \d{4}", "MMMM d, yyyy"), (r"^[A-Za-z]+ \d{1,2}, \d{4}", "MMM d, yyyy")]


def parse_date(text: Column, as_of: Column) -> Column:
    """A date in one of several formats, or relative to as_of; as_of where nothing fits; null for blank text.

    A leading `Posted:` is left out. `today` and `yesterday` come first, then days, weeks and months ago; a
    missing number is one. Months keep to the end of the month.
    """
    t = F.trim(F.regexp_replace(text, r"(?i)^\s*posted\s*:", ""))
    exact = [F.to_date(F.try_to_timestamp(F.regexp_substr(t, F.lit(p)), F.lit(f))) for p, f in DATE_FORMATS]
    low = F.lower(t)
    n = F.coalesce(F.regexp_substr(low, F.lit(r"\d+")).cast("int"), F.lit(1))
    relative = (
        F.when(low.contains("today"), as_of)
        .when(low.contains("yesterday"), F.date_sub(as_of, 1))
        .when(low.contains("day"), F.date_sub(as_of, n))
        .when(low.contains("week"), F.date_sub(as_of, n * 7))
        .when(low.contains("month"), F.add_months(as_of, -n))
        .otherwise(as_of)
    )
    return F.when(F.length(t) > 0, F.coalesce(*exact, relative))


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day), F.lit("_"), F.year(day))


def group_or_null(text: Column, pattern: str, group: int = 1) -> Column:
    """A capture group; null (not empty) without a match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def tenant_of(url: Column) -> Column:
    """First label of the host."""
    return group_or_null(url, r"^https?://([^./]+)\.")


def base_of(url: Column) -> Column:
    """Scheme and host."""
    return group_or_null(url, r"^(https?://[^/?#]+)")


def site_of(url: Column, default: str = "External") -> Column:
    """First path segment that is not a locale; the default without one."""
    return F.coalesce(group_or_null(url, r"^https?://[^/]+/(?:[a-z]{2}-[A-Z]{2}/)?([^/?#]+)"), F.lit(default))


def site_number_of(url: Column, default: str = "CX") -> Column:
    return F.coalesce(group_or_null(url, r"/sites/([^/?#]+)"), F.lit(default))


def query_params(url: Column) -> Column:
    """The query of a URL as a map; the fragment is left out."""
    query = group_or_null(url, r"\?([^#]*)")
    return F.when(F.length(query) > 0, F.str_to_map(query, F.lit("&"), F.lit("=")))


def listing_filters(url: Column) -> Column:
    """struct(q, facets, states) of a listing URL: the search text, the ids of each `facet_` parameter, and states."""
    params = F.coalesce(query_params(url), F.create_map().cast("map<string,string>"))
    plain = F.map_from_entries(F.transform(F.map_entries(params), lambda e: F.struct(e["key"].alias("key"), F.url_decode(F.replace(F.coalesce(e["value"], F.lit("")), F.lit("+"), F.lit("%20"))).alias("value"))))
    facets = F.transform_keys(F.map_filter(plain, lambda k, _: k.startswith("facet_")), lambda k, _: F.substring(k, 7, 1000))
    return F.struct(F.coalesce(plain["q"], F.lit("")).alias("q"), F.transform_values(facets, lambda _, v: F.split(v, ",")).alias("facets"), F.coalesce(F.split(plain["states"], ","), F.array().cast("array<string>")).alias("states"))


def dayforce_namespace(url: Column) -> Column:
    """Lower-case client of a job-board URL: the second path part, or the first where there is no second."""
    second, first = r"dayforcehcm\.com/[^/]+/([^/]+)/", r"dayforcehcm\.com/([^/]+)/"
    return F.lower(F.coalesce(group_or_null(url, second), group_or_null(url, first)))


def api_base_of(url: Column) -> Column:
    """Base of a careers host's listing service."""
    return F.concat(base_of(url), F.lit("/hcmRestApi/resources/latest"))


def absolutize(href: Column, base: Column) -> Column:
    """An absolute link as it is; a relative one below the base."""
    path = F.when(href.startswith("/"), href).otherwise(F.concat(F.lit("/"), href))
    return F.when(href.rlike("^https?://"), href).otherwise(F.concat(base, path))


def strip_tags(html: Column, by: str = " ") -> Column:
    return F.regexp_replace(html, r"<[^>]+>", by)


#: Named and numeric references and what they stand for.
ENTITIES = [("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&rsquo;", "’"), ("&lsquo;", "‘"), ("&ndash;", "–"), ("&mdash;", "—"), ("&bull;", "•"), ("&amp;", "&")]


def decode_entities(text: Column, rest: str | None = None) -> Column:
    """Known references, ampersands last; any other becomes `rest` if it is given."""
    out = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)
    return out if rest is None else F.regexp_replace(out, r"&[#a-zA-Z0-9]+;", rest)


#: Pay patterns of the platforms; the first that matches wins.
MONEY = r"\$[0-9][0-9,]*(?:\.[0-9]+)?"
SALARY = [rf"{MONEY}\s*(?:-|–|to|and)\s*{MONEY}", rf"{MONEY}\+"]
SALARY_USD = r"([0-9][0-9,]*(?:\.[0-9]+)?) USD - ([0-9][0-9,]*(?:\.[0-9]+)?) USD"


def salary(text: Column) -> Column:
    """A pay range or lower bound as text: the match itself, or `$a-$b` from amounts before USD."""
    usd = F.when(text.rlike(SALARY_USD), F.concat(F.lit("$"), F.regexp_extract(text, SALARY_USD, 1), F.lit("-$"), F.regexp_extract(text, SALARY_USD, 2)))
    return F.coalesce(*[F.regexp_substr(text, F.lit(p)) for p in SALARY], usd)


#: Pay texts of the platforms that name a minimum and a maximum.
AMOUNT = r"\$([0-9,]+(?:\.\d{2})?)"
MIN_MAX = rf"(?i)(?:pay range|salary range)[^\n]*?MIN\s*{AMOUNT}(?:[^\n]*?MAX\s*{AMOUNT})?"
USD_RANGE = rf"(?i)pay\s+range[^\n]*?USD\s+{AMOUNT}\s*[-–]\s*USD\s+{AMOUNT}"
HOURLY = rf"(?i)(?:pay range|salary range)[^\n]*?{AMOUNT}\s*hourly?\s*[-–]\s*{AMOUNT}\s*hourly?"
LABELLED = r"\$[0-9,]+(?:\.[0-9]{2})?\s*[-–]\s*\$[0-9,]+(?:\.[0-9]{2})?"


def _range(text: Column, pattern: str, after: str = "") -> Column:
    low, high = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    both = F.concat(F.lit("$"), low, F.lit("-$"), high, F.lit(after))
    return F.when(text.rlike(pattern), F.when(F.length(high) > 0, both).otherwise(F.concat(F.lit("$"), low, F.lit("+"))))


def icims_pay(least: Column, most: Column, html: Column) -> Column:
    """Pay of the target tags if both hold an amount, else of the description: MIN and MAX, USD range, hourly."""
    low, high = F.regexp_substr(least, F.lit(r"\$[0-9,]+")), F.regexp_substr(most, F.lit(r"\$[0-9,]+"))
    text = strip_tags(F.coalesce(html, F.lit("")))
    return F.coalesce(F.concat(low, F.lit("-"), high), _range(text, MIN_MAX), _range(text, USD_RANGE), _range(text, HOURLY, "/hr"))


def labelled_pay(labels: Column, label: str, otherwise: Column) -> Column:
    """The range in the first of the texts that holds the label, whether it has one or not; without such a text, in otherwise."""
    first = F.get(F.filter(labels, lambda x: F.contains(F.lower(x), F.lit(label.lower()))), 0)
    return F.when(first.isNotNull(), F.regexp_substr(first, F.lit(r"\$[0-9,]+-\$[0-9,]+"))).otherwise(F.regexp_substr(otherwise, F.lit(r"\$[0-9,]+-\$[0-9,]+")))


def keyword_flag(text: Column, pattern: str, negative: str) -> Column:
    """Yes, No or null: No wins, and blank text gives null."""
    return F.when(F.length(text) > 0, F.when(text.rlike(negative), "No").when(text.rlike(pattern), "Yes"))


#: Terms of the trade; any of them makes a posting one of it.
KEYWORDS = "semiconductor|wafer|fab|lithography|etching|deposition|CMP|metrology|yield|process engineer|device|IC|chip|ASIC|analog|digital|mixed-signal|CMOS|BiCMOS|memory|logic|power semiconductor"


def has_keyword(text: Column) -> Column:
    """Whether a term of the trade stands in the text as words of its own, whatever its case."""
    return text.rlike(rf"(?i)\b(?:{KEYWORDS})\b")


#: Labels of a plain text's fields, each with where it ends; the first that fits wins.
LABELS = {
    "job_responsibilities": [r"Responsibilities:?(.+?)(?=Qualifications|Requirements|Education|Experience|$)", r"Job Description:?(.+?)(?=Qualifications|Requirements|Education|$)", r"What You'll Do:?(.+?)(?=What You'll Need|Qualifications|$)"],
    "min_education": [r"Education:?(.+?)(?=Experience|Qualifications|Skills|$)", r"(Bachelor's|Master's|PhD|Associate's).{0,100}(?:degree|required)", r"()(?:BS|MS|PhD).{0,50}in.{0,50}(?:Engineering|Science|Computer)"],
    "min_experience": [r"Experience:?(.+?)(?=Education|Skills|Qualifications|$)", r"(\d+\+?\s*years?).{0,100}(?:experience|of experience)"],
    "preferred_qualifications": [r"Preferred Qualifications:?(.+?)(?=Salary|Benefits|Equal|$)", r"Nice to Have:?(.+?)(?=Salary|Benefits|$)", r"Preferred:?(.+?)(?=Salary|Benefits|Equal|$)"],
    "salary_range": [r"Salary Range:?(.+?)(?=Benefits|Equal|$)", r"Compensation:?(.+?)(?=Benefits|Equal|$)", r"()\$[0-9,.]+K?\s*-\s*\$[0-9,.]+K?"],
}


def labelled_fields(text: Column) -> Column:
    """struct of the five fields of a plain text: what follows a label, or the match of a pattern without one. Texts
    under three characters are null."""
    flat = squish(text)

    def field(patterns: list[str]) -> Column:
        found = [F.when(flat.rlike(f"(?i){p}"), F.regexp_substr(flat, F.lit(f"(?i){p}")) if p.startswith("()") else F.regexp_extract(flat, f"(?i){p}", 1)) for p in patterns]
        return clean_text(F.coalesce(*found))

    return F.struct(*[field(ps).alias(name) for name, ps in LABELS.items()])
