"""Functions on arrays of short lines (bullets of a posting)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: words that make a line one about education.
EDUCATION = r"(?i)\b(?:bachelor|master|phd|ph\.d|doctorate|diploma|degree)|\b(?:BS|MS|BSEE|MSEE)\b"
EXPERIENCE = r"(?i)\byears?\b|\bexperience\b"


def lines_of(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.trim(x))


def keep_lines(lines: Column, longer_than: int, drop: str | None = None) -> Column:
    """Lines over a length that do not match `drop`."""
    return F.filter(lines, lambda x: (F.length(x) > longer_than) & (F.lit(True) if drop is None else ~F.coalesce(x.rlike(drop), F.lit(False))))


def partition_lines(lines: Column) -> Column:
    """struct(education, experience, other); the first class that fits takes the line."""
    edu = F.filter(lines, lambda x: x.rlike(EDUCATION))
    rest = F.filter(lines, lambda x: ~x.rlike(EDUCATION))
    return F.struct(edu.alias("education"), F.filter(rest, lambda x: x.rlike(EXPERIENCE)).alias("experience"), F.filter(rest, lambda x: ~x.rlike(EXPERIENCE)).alias("other"))


def dedup_lines(lines: Column, long: int = 20) -> Column:
    """Lines over `long` characters are kept once, shorter ones always."""
    keyed = F.transform(lines, lambda x, i: F.struct(x.alias("line"), F.when(F.length(x) <= long, i).alias("i")))
    return F.transform(F.array_distinct(keyed), lambda k: k["line"])


def or_split(lines: Column) -> Column:
    """`A - OR - B` in the first line gives the education and the experience; nulls unless two parts."""
    parts = F.split(F.get(lines, 0), r"\s+-\s+OR\s+-\s+")
    two = F.size(parts) == 2
    return F.struct(F.when(two, parts[0]).alias("education"), F.when(two, parts[1]).alias("experience"))


def expand_bullets(lines: Column) -> Column:
    """`DEGREE + N years ...` becomes two lines."""
    pattern = r"^(.*\S)\s*\+\s*([0-9]+\s+years?.*)$"
    return F.flatten(F.transform(lines, lambda x: F.when(x.rlike(pattern), F.array(F.regexp_extract(x, pattern, 1), F.regexp_extract(x, pattern, 2))).otherwise(F.array(x))))


def promote(preferred: Column, education: Column) -> Column:
    """struct(education, preferred): without education, the first education line moves over from preferred."""
    found = F.get(F.filter(preferred, lambda x: x.rlike(EDUCATION)), 0)
    moves = education.isNull() & found.isNotNull()
    return F.struct(F.coalesce(education, found).alias("education"), F.when(moves, F.array_except(preferred, F.array(found))).otherwise(preferred).alias("preferred"))


def once(value: Column, body) -> Column:
    """body(value) with value worked out once, also where body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def joined(lines: Column, by: str = "\n") -> Column:
    """The lines as one text; null without any."""
    return F.when(F.size(lines) > 0, F.array_join(lines, by))


def split_preferred(lines: Column, education: str) -> Column:
    """struct(kept, preferred): from an education line, a sentence that says `preferred` after the first one moves over."""
    pattern = r"(?i)^(.+?[.])\s+(.+\bpreferred\b.*)$"

    def pieces(x: Column) -> Column:
        moves = x.rlike(pattern) & F.regexp_extract(x, pattern, 1).rlike(education)
        return F.struct(F.when(moves, F.regexp_extract(x, pattern, 1)).otherwise(x).alias("kept"), F.when(moves, F.regexp_extract(x, pattern, 2)).alias("preferred"))

    return once(F.transform(lines, pieces), lambda p: F.struct(F.transform(p, lambda x: x["kept"]).alias("kept"), F.array_compact(F.transform(p, lambda x: x["preferred"])).alias("preferred")))


def split_credentials(text: Column) -> Column:
    """struct(education, preferred) of `Bachelor's or Master's degree (preferred) in X`: both get the field, and the
    first the word degree if it lacks one; any other text is education as a whole."""
    pattern = r"(?i)^(bachelor[^,]+?)\s+or\s+(master[^(,]+?)\s*\(preferred\)\s*(in\s+.+)$"
    first, second, of = (F.trim(F.regexp_extract(text, pattern, k)) for k in (1, 2, 3))
    word = F.coalesce(F.regexp_substr(second, F.lit(r"(?i)\b(?:degree|diploma)\b")), F.lit("degree"))
    named = F.when(first.rlike(r"(?i)\b(?:degree|diploma)\b"), first).otherwise(F.concat(first, F.lit(" "), word))
    two = text.rlike(pattern)
    return F.struct(F.when(two, F.concat(named, F.lit(" "), of)).otherwise(text).alias("education"), F.when(two, F.concat(second, F.lit(" "), of)).alias("preferred"))


def assemble(summary: Column, parts: Column) -> Column:
    """Summary and parts as one text, a blank line between them. The summary is left out if its first 80 characters
    are in a part; lines over 20 characters are kept once."""
    known = F.filter(parts, lambda x: F.length(x) > 0)
    again = F.exists(known, lambda x: F.contains(x, F.substring(summary, 1, 80)))
    every = F.when(summary.isNull() | again, known).otherwise(F.concat(F.array(summary), known))
    return once(every, lambda p: F.when(F.size(p) > 0, F.array_join(dedup_lines(F.split(F.array_join(p, "\n\n"), "\n")), "\n")))
