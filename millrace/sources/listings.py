"""Listing pages of HTML as rows, with regular expressions on the columns: no parse of the whole page is needed.

Each function takes a page and gives an array of structs, one for each posting, in page order. A posting without
a link or a title isn't one. A value that is used more than once is bound by once(), since Spark would work it out
again at each use inside a lambda. Dates are those of the page; links are made absolute by the caller's base.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.lines import once
from millrace.functions.scalars import absolutize, decode_entities, group_or_null, squish, strip_tags


def _text(html: Column) -> Column:
    return squish(decode_entities(strip_tags(html, " ")))


def _all(html: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


def _us_date(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(F.regexp_substr(text, F.lit(r"\d{1,2}/\d{1,2}/\d{4}")), F.lit("M/d/yyyy")))


def _href(link: Column, base: Column) -> Column:
    """A link's absolute target, which is looked for once."""
    return once(group_or_null(link, r"href=[\"']([^\"']*)[\"']"), lambda href: absolutize(href, base))


def _kept(items: Column) -> Column:
    return F.filter(items, lambda x: x["job_url"].isNotNull() & (F.length(x["job_title"]) > 0))


def result_items(html: Column, base: Column) -> Column:
    """`li` items whose link of class sr-job-link holds an h2 and spans: the first is the place, `Posted:` the date."""

    def read(link: Column, spans: Column) -> Column:
        posted = F.get(F.filter(spans, lambda s: F.contains(s, F.lit("Posted"))), 0)
        return F.struct(_text(group_or_null(link, r"(?s)<h2[^>]*>(.*?)</h2>")).alias("job_title"), F.get(spans, 0).alias("location"), _href(link, base).alias("job_url"), _us_date(posted).alias("posting_date"))

    def one(item: Column) -> Column:
        link = F.regexp_substr(item, F.lit(r"(?s)<a\b[^>]*class=[\"'][^\"']*sr-job-link.*?</a>"))
        return once(link, lambda x: once(F.transform(_all(x, r"(?s)<span\b[^>]*>.*?</span>"), _text), lambda spans: read(x, spans)))

    return _kept(F.transform(_all(html, r"(?s)<li\b.*?</li>"), one))


def job_links(html: Column, base: Column) -> Column:
    """Links below /job/, each with its own first span as title and the place and date that follow it."""

    def one(part: Column) -> Column:
        href = group_or_null(part, r"^<a\b[^>]*href=[\"'](/job/[^\"']*)[\"']")
        field = lambda name: _text(group_or_null(part, rf"(?s)<span[^>]*class=[\"'][^\"']*\b{name}\b[^\"']*[\"'][^>]*>(.*?)</span>"))
        title = _text(group_or_null(part, r"(?s)^<a\b[^>]*>.*?<span[^>]*>(.*?)</span>"))
        return F.struct(title.alias("job_title"), field("location").alias("location"), F.concat(base, href).alias("job_url"), _us_date(field("date")).alias("posting_date"))

    return _kept(F.transform(_all(html, r"(?s)<a\b(?:(?!<a\b).)*"), one))


def table_rows(html: Column, base: Column) -> Column:
    """Rows of class data-row, or all table rows where there are none: the title link (by class, else the first one
    to /job/), and the place from its span or else from the second cell."""
    def rows(page: Column) -> Column:
        marked = _all(page, r"(?s)<tr\b[^>]*class=[\"'][^\"']*data-row.*?</tr>")
        return once(marked, lambda m: F.when(F.size(m) > 0, m).otherwise(_all(page, r"(?s)<tr\b.*?</tr>")))

    def one(row: Column) -> Column:
        named = F.regexp_substr(row, F.lit(r"(?s)<a\b[^>]*jobTitle-link.*?</a>"))
        link = F.coalesce(named, F.regexp_substr(row, F.lit(r"(?s)<a\b[^>]*href=[\"'][^\"']*/job/.*?</a>")))
        cells = _all(row, r"(?s)<td\b.*?</td>")
        place = F.coalesce(group_or_null(row, r"(?s)<span[^>]*jobLocation[^>]*>(.*?)</span>"), F.get(cells, 1))
        return once(link, lambda x: F.struct(_text(x).alias("job_title"), _text(place).alias("location"), _href(x, base).alias("job_url"), F.lit(None).cast("date").alias("posting_date")))

    return _kept(F.transform(once(html, rows), one))
