"""Sections of a posting by the form of their headings.

A page is a list of lines that know their form (htmltext.render). Each platform has rules: which forms a heading
may have and in which order they are tried, which of several places counts, and what ends a section that a heading
of that form opened. The nearest stop ends it. Small Spark-free helpers; Spark calls them once for each page, for
all sections together (millrace.operators.details.located_sections).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

from millrace.functions.htmltext import Line

HEADS = ("h1", "h2", "h3", "h4", "h5", "h6")
ANY = (*HEADS, "bold", "lead", "p", "text")


@dataclass(frozen=True)
class Rules:
    """How the sections of a platform are read."""

    forms: tuple[tuple[str, ...], ...] = (ANY,)  # groups of forms, tried in order
    stops: tuple[tuple[str, tuple[str, ...]], ...] = ()  # for a heading of a form, what ends its section
    otherwise: tuple[str, ...] = ("heading", "known")  # what ends those of all other forms
    last: bool = False  # of several places the last one with text counts
    known: str = r"(?!)"  # headings of the platform
    drop: str | None = None  # lines that belong to no section
    cut: bool = False  # a line to drop also ends the section that no form of heading opened
    bullets: bool = False  # only list items, if there are any
    least: int = 3  # shorter paragraphs are dropped, list items never
    loose: bool = False  # where no form fits, a line that is the heading and nothing else opens a section


def _ends(line: Line, following: Line | None, stop: str, known: re.Pattern[str]) -> bool:
    """Whether a line ends a section by a stop; list items never do."""
    if line.bullet:
        return False
    if stop == "heading":
        return line.heading
    if stop == "bold":
        return line.form == "bold" and line.text[:1].isupper() or line.lead[:1].isupper()
    if stop == "known":
        return known.fullmatch(line.text) is not None or (line.lead != "" and known.fullmatch(line.lead) is not None)
    if stop == "titled list":
        return following is not None and following.bullet and re.fullmatch(r"[A-Z][A-Za-z &/-]{2,50}", line.text) is not None
    return line.form == stop


@cache
def _heading(pattern: str) -> re.Pattern[str]:
    return re.compile(rf"(?:{pattern})\s*:?\s*", re.I)


def _places(lines: list[Line], spots: list[int], pattern: re.Pattern[str], forms: tuple[str, ...]) -> Iterator[tuple[int, str, str]]:
    """(line, form, what follows the heading on it) of each heading among the spots that has one of the forms."""
    for i in spots:
        x = lines[i]
        if x.bullet:
            continue
        if x.form in forms and pattern.fullmatch(x.text):
            yield i, x.form, ""
        elif "lead" in forms and x.lead and pattern.fullmatch(x.lead):
            yield i, "lead", x.text[len(x.lead) :].lstrip(" :")
        elif x.form in forms and (m := pattern.match(x.text)) and ":" in m[0] and m.end() < len(x.text):
            yield i, x.form, x.text[m.end() :]


def _content(lines: list[Line], start: int, rest: str, stops: tuple[str, ...], rules: Rules, known: re.Pattern[str], cut: bool) -> list[str] | None:
    found = [Line(rest, False, False)] if rest else []
    for i in range(start + 1, len(lines)):
        after = lines[i + 1] if i + 1 < len(lines) else None
        if any(_ends(lines[i], after, s, known) for s in stops):
            break
        if rules.drop and re.search(rules.drop, lines[i].text):
            if cut:
                break
            continue
        found.append(lines[i])
    if rules.bullets and any(x.bullet for x in found):
        found = [x for x in found if x.bullet]
    texts = [x.text for x in found if x.bullet or len(x.text) >= rules.least]
    return texts or None


def section_of(lines: list[Line], patterns: list[str], rules: Rules, stops: tuple[str, ...] | None = None) -> list[str] | None:
    """Lines of the first pattern's section that has any; None without one.

    Patterns are tried in order, for each its forms in order, and for each form its places in the page's order (or
    from the last one). stops takes the place of the rules' own.
    """
    if not patterns:
        return None
    some = _heading("|".join(patterns))  # few lines open with any of the headings
    spots = [i for i, x in enumerate(lines) if some.match(x.text) or (x.lead and some.match(x.lead))]
    if not spots:
        return None
    known, headings = _heading(rules.known), [_heading(p) for p in patterns]
    by_form = dict(rules.stops)
    for heading in headings:
        for forms in rules.forms:
            places = list(_places(lines, spots, heading, forms))
            for i, form, rest in reversed(places) if rules.last else places:
                if texts := _content(lines, i, rest, stops or by_form.get(form, rules.otherwise), rules, known, False):
                    return texts
    for heading in headings if rules.loose else []:
        i = next((i for i in spots if heading.fullmatch(lines[i].text)), None)
        if i is not None and (texts := _content(lines, i, "", ("known",), rules, known, rules.cut)):
            return texts
    return None


def intro_of(lines: list[Line], patterns: list[str], stop: str, least: int = 30) -> str | None:
    """The paragraph that a pattern's first line opens, up to a line that looks like a heading, if it is longer than
    `least`; patterns are tried in order."""
    for pattern in patterns:
        for i, x in enumerate(lines):
            if not re.match(pattern, x.text):
                continue
            texts = [x.text]
            for y in lines[i + 1 :]:
                if y.block != x.block or y.heading or re.match(stop, y.text):
                    break
                texts.append(y.text)
            if len(text := " ".join(texts)) > least:
                return text
    return None
