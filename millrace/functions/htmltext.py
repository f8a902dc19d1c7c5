"""Rendering of posting HTML to lines, and the sections that headings open.

Small Spark-free helpers; Spark calls them in Arrow batches (millrace.operators.details).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

_BREAK = frozenset("address article blockquote body div dl dt dd footer form h1 h2 h3 h4 h5 h6 header hr li main ol p section table td th tr ul".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_SKIP = frozenset("script style noscript template".split())


@dataclass
class Line:
    text: str
    bullet: bool  # it stands in a list item
    heading: bool  # it is a heading tag or wholly bold
    form: str = "text"  # h1 to h6, bold, li, p or text
    lead: str = ""  # the bold text it opens with, if more follows
    block: int = 0  # lines of one paragraph, which breaks part, share it


class _Renderer(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.lead: list[str] = []
        self.bold_chars = self.chars = self.block = 0
        self.head = ""
        self.depth = {"li": 0, "bold": 0, "head": 0, "skip": 0, "p": 0}

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for line numbers

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        lead = " ".join("".join(self.lead).split())
        self.parts.clear()
        self.lead.clear()
        if text:
            bold = self.chars > 0 and self.bold_chars == self.chars
            bullet = self.depth["li"] > 0
            form = "li" if bullet else self.head if self.depth["head"] else "bold" if bold else "p" if self.depth["p"] else "text"
            self.lines.append(Line(text, bullet, (self.depth["head"] > 0 or bold) and not bullet, form, "" if bold else lead, self.block))
        self.bold_chars = self.chars = 0

    def move(self, tag: str, by: int) -> None:
        for name, tags in (("li", {"li"}), ("bold", {"b", "strong"}), ("head", _HEADING), ("skip", _SKIP)):
            if tag in tags:
                self.depth[name] = max(0, self.depth[name] + by)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BREAK or tag == "br":
            self.flush()
        if tag == "li":
            self.depth["li"] = 0  # an item that was left open
        if tag in _BREAK and tag != "li":
            self.depth["bold"] = 0
        if tag in _BREAK:  # a paragraph that was left open
            self.depth["p"] = int(tag == "p")
        self.block += tag == "p"
        self.head = tag if tag in _HEADING else self.head
        self.move(tag, 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BREAK:
            self.flush()
        self.move(tag, -1)
        if tag == "p":
            self.depth["p"] = 0
            self.block += 1
        if tag in ("ul", "ol"):
            self.depth["li"] = 0

    def handle_data(self, data: str) -> None:
        if self.depth["skip"]:
            return
        self.parts.append(data)
        if self.chars == self.bold_chars and (self.depth["bold"] or not data.strip()):
            self.lead.append(data)
        n = len(data.strip())
        self.chars += n
        self.bold_chars += n if self.depth["bold"] else 0


def render(html: str | None) -> list[Line]:
    r = _Renderer()
    r.feed(html or "")
    r.close()
    r.flush()
    return r.lines


@dataclass
class Policy:
    """How a platform's sections are read."""

    least: int = 3  # shorter lines are dropped
    bullets_first: bool = True  # only list items, if there are any
    last: bool = False  # of repeated headings the last one counts
    inline: bool = True  # text after the heading on its line belongs to the section
    stop: str | None = None  # besides headings, what ends a section
    drop: str | None = None  # lines to leave out


def section(lines: list[Line], patterns: list[str], policy: Policy) -> list[str] | None:
    """Lines below the first pattern's heading that has any; None without one."""
    for pattern in patterns:
        start = re.compile(rf"(?:{pattern})\s*:?\s*", re.I)
        spots = [(i, m) for i, x in enumerate(lines) if not x.bullet and (m := start.match(x.text)) and (x.heading or m.end() == len(x.text) or (policy.inline and x.text[m.end() - 1 :].lstrip()[:1] != "" and ":" in m[0]))]
        for i, m in reversed(spots) if policy.last else spots:
            found: list[Line] = []
            if policy.inline and m.end() < len(lines[i].text):
                found.append(Line(lines[i].text[m.end() :], False, False))
            for x in lines[i + 1 :]:
                if x.heading or (policy.stop and not x.bullet and re.match(policy.stop, x.text)):
                    break
                found.append(x)
            if policy.bullets_first and any(x.bullet for x in found):
                found = [x for x in found if x.bullet]
            texts = [re.sub(r"^[•·*\-]\s*", "", x.text) for x in found]
            texts = [t for t in texts if len(t) >= policy.least and not (policy.drop and re.search(policy.drop, t))]
            if texts:
                return texts
    return None


def prose(lines: list[Line], strip: str, discard: str, least: int = 20, most: int = 5000) -> str | None:
    """Paragraphs that are no boilerplate, joined by blank lines."""
    kept = [re.sub(strip, "", x.text).strip() for x in lines]
    text = "\n\n".join(t for t in kept if len(t) >= least and not re.search(discard, t))[:most]
    return text if len(text) >= 30 else None


def strip_boilerplate(text: str, rules: list[tuple[str, str]]) -> str:
    """Rules (mode, pattern) in order. `all` always applies; of the `first` rules the first that shortens."""
    done = False
    for mode, pattern in rules:
        if mode == "all":
            text = re.sub(pattern, "", text)
        elif not done and (shorter := re.sub(pattern, "", text)) != text:
            text, done = shorter, True
    return text


def links(html: str | None, marker: str) -> list[tuple[str, str]]:
    """(href, text) of the anchors whose attributes match."""
    out = []
    for m in re.finditer(r"<a\b([^>]*)>(.*?)</a>", html or "", re.S | re.I):
        href = re.search(r"""href\s*=\s*["']?([^"'\s>]+)""", m[1])
        if href and re.search(marker, m[1]):
            out.append((href[1], " ".join(re.sub(r"<[^>]+>", " ", m[2]).split())))
    return out


def repair_bytes(raw: bytes) -> str:
    """UTF-8 text; only bytes that are no valid UTF-8 are read as cp1252, so 0x92 becomes U+2019."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode())
            out.append(raw[at + e.start : at + e.end].decode("cp1252", "replace"))
            at += e.end
    return "".join(out)
