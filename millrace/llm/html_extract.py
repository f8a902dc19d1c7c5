"""Main-text extraction by a minimum cut.

A page is cut into text blocks at block-level tags. A classifier gives each block the log-odds of being
main text, which are its capacity: to the content terminal if positive, to the boilerplate terminal if
negative. Blocks next to each other, and neighbouring children of one parent, are tied by smoothness edges
that weigh more the closer they are in the tree. The maximum flow between the terminals gives the labelling
of least total cost: blocks on the content side are the main text.

The log-odds are those of the block's own text and of the parts of the page it stands in:

- text: a logistic regression on FEATURES, which look at the block and at its siblings. No page is labelled, so its weights are fitted on weak labels,
  the blocks inside `article` or `main` against those inside navigation, footers, asides and the like, by
  Newton steps whose sums Spark takes over a sample of about `fit_pages` pages (a parameter; pages are drawn
  by a hash of id and url). TEXT_PRIOR is the weights' prior and stands where a table has no such parts. It
  weighs as much as PRIOR_SHARE of the blocks, since weak labels know their own kind of page only;
- parts: priors for elements and for names in class, id, role, aria-label and itemprop. They add up, so a
  block can be kept against one of them. A name with a word that says nothing (`related-work`) counts less.
  A form that holds more than half of a page's text is the page and not a part of it, and so is an element
  whose name is about the main part and another one (`content-sidebar-wrap`).

Pages are independent, so after the fit one narrow pass does it; a worker holds one page's blocks at a time.

Edge cases: null or empty html gives an empty text; a page without any element is one block and is kept;
unclosed tags end where HTML ends them, and a stray quote belongs to its tag; very long and very deep
pages are taken whole; repeated rows and ties are extracted one by one; an empty table gives an empty table;
other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, drop_table, ship

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}}
SCOPE = frozenset("article aside body datalist div dl footer form header main nav ol optgroup section select table td th ul li blockquote".split())
UNSEEN = frozenset("script style noscript template svg iframe object head title textarea select button canvas audio video datalist".split())
RAW = frozenset("script style textarea title iframe noscript".split())

#: A quote opens a value only after an equals sign; elsewhere it is part of a name.
_ATTRIBUTE = r"""[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+|="""
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:{_ATTRIBUTE})*+)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
#: Names of parts that are not the article, of the article, and words beside them that say nothing.
OTHER_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs byline captcha comment commentlist comments cookie cookies consent contentinfo copyright disclaimer disqus dialog dropdown footer form gdpr header hidden login masthead menu menubar modal nav navbar navigation newsletter notice notification alert outbrain pager paging pagination paywall popup print privacy promo promotion recommended recommendations related replies reply respond responses search share sharing side sidebar signup skip social sponsor sponsored subscribe subscription taboola tags toc toolbar topbar widget widgets".split()
)
MAIN_PARTS = frozenset("article articlebody body content entry hentry main post story text".split())
PLAIN_PARTS = frozenset("a above area articles aside bar below block bottom box buttons button col column container end first global group holder icons in inner item items js last layer layout left link links list module more of on outer overlay page panel posts primary region right row secondary section site slot stories sub the to top unit view wrap wrapper zone".split())

#: Words of a name that tell what an element holds: content-sidebar-wrap is around both.
AROUND = frozenset("container holder inner layout outer wrap wrapper".split())

#: Log-odds of parts: an element or a name that is no main text, one with an unknown word beside it, the main part.
AWAY, PERHAPS_AWAY, IN_MAIN = -6.0, -2.0, 3.0
FEATURES = ("one", "words", "linked share", "ends a sentence", "paragraph or heading", "copyright or cookie mark", "list item or cell", "linked share of the siblings")
TEXT_PRIOR = (-0.6, 1.6, -4.0, 0.6, 0.5, -2.5, -0.3, -1.5)
PRIOR_BLOCKS, PRIOR_SHARE, FIT_STEPS = 20.0, 0.1, 6
#: Words from which a block is long.
LONG = 40
MARK = re.compile(r"©|\(c\) (?:19|20)\d\d|all rights reserved|\b(?:we|site|website|page) uses? cookies\b|\baccept (?:all )?cookies\b|\bcookie (?:policy|settings|preferences)\b", re.I)
ENDS = re.compile(r"[.!?:;…»\"”)]$")


@dataclass
class Block:
    text: str
    features: tuple[float, ...]
    parts: float  # log-odds of the parts it is in, without forms
    forms: tuple[int, ...]  # ids of the open forms and of what is around the main part by its name
    main: bool
    parent: int  # id of the block-level element around its own
    depth: int
    shared: int  # block-level elements that are open in this block and in the one before
    linked: int  # characters inside of links
    score: float = 0.0


def names_in(attrs: str) -> tuple[list[set[str]], bool]:
    """Lower-case words of each name of the naming attributes, and whether the element is hidden."""
    names: list[set[str]] = []
    hidden = False
    for name, value in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), entities.unescape(value.strip("\"'"))
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            for one in value.split():  # has-sidebar says what an element holds, not what it is
                if not re.match(r"(?:has|with|no|without)[-_]", one):
                    names.append(set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", one).lower())) - {""})
        hidden |= name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) is not None)
    return names, hidden


def part_score(tag: str, attrs: str, inside_main: bool) -> tuple[float, bool, bool]:
    """What an open element says of the blocks in it, whether it is the main part, and whether its name says that
    it may be around the main part (then how much it holds decides)."""
    if tag in ("nav", "footer", "aside", "dialog", "menu", "search"):
        return AWAY, False, False
    names, hidden = names_in(attrs) if attrs.strip() else ([], False)
    if hidden:
        return AWAY, False, False
    # main-header is the header of a site, entry-header that of an article
    own = any("header" in words and words & MAIN_PARTS - {"main"} for words in names) or tag == "header" and any(words & MAIN_PARTS - {"main"} for words in names)
    main = tag in ("article", "main") or (tag in ("div", "section", "td") and any(words & MAIN_PARTS for words in names)) or (tag == "header" and own)
    around = False
    if tag not in ("html", "body", "h1", "h2", "h3", "article", "main"):
        worst = 0.0
        for words in names:
            other = words & OTHER_PARTS
            if inside_main or words & MAIN_PARTS - {"main"}:  # an article's own heading
                other -= {"header", "masthead"}
            if other and not inside_main and words & MAIN_PARTS and words & AROUND:
                around = True
            elif other:
                worst = min(worst, AWAY if words <= OTHER_PARTS | MAIN_PARTS | PLAIN_PARTS else PERHAPS_AWAY)
        if worst < 0:
            return worst, False, False
    if tag == "header" and not inside_main and not own:
        return AWAY, False, False
    if around:
        return 0.0, False, True
    return (IN_MAIN if main and not inside_main else 0.0), main, False


def features_of(text: str, linked: int, tag: str) -> tuple[float, ...]:
    n = len(text.split())
    return (1.0, min(n, LONG) / 20, min(1.0, linked / max(1, len(text))), float(bool(ENDS.search(text))), float(tag in ("p", "h1", "h2", "h3", "h4", "blockquote", "pre")), min(1.0, 20 / n) * bool(MARK.search(text)), float(tag in ("li", "td", "th", "dd", "dt")), 0.0)


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page, without scores."""
    out: list[Block] = []
    stack: list[tuple[str, float, bool, tuple[int, ...]]] = []  # tag, log-odds of the parts, in the main part, forms
    boxes: list[tuple[int, str]] = []  # the block-level ones
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked, at, serial, unseen, links, low = 0, 0, 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked, low
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            _, said, main, forms = stack[-1] if stack else ("", 0.0, False, ())
            tag = boxes[-1][1] if boxes else ""
            out.append(Block(text, features_of(text, linked, tag), said, forms, main, boxes[-2][0] if len(boxes) > 1 else 0, len(boxes), min(low, len(boxes)), min(linked, len(text))))
            low = len(boxes)
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal unseen, links, low
        if any(s[0] in BLOCK for s in stack[depth:]):
            flush()
        for s in stack[depth:]:
            opened[s[0]] -= 1
            if s[0] in BLOCK:
                boxes.pop()
            unseen -= s[0] in UNSEEN
            links -= s[0] == "a"
        low = min(low, len(boxes))
        del stack[depth:]

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not unseen:
            text = entities.unescape(raw)
            parts.append(text)
            if links:
                linked += len(text.strip())

    while at < len(page):
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag] > 0:
                pop_to(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            elif tag == "p":
                flush()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK or tag in CLOSES:
            closing = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCK else set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in closing:
                    pop_to(k)
                    break
                if stack[k][0] in SCOPE and stack[k][0] not in closing:
                    break
            if tag in BLOCK:
                flush()
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag == "body":  # whatever the head left open
            pop_to(next((k for k, s in enumerate(stack) if s[0] != "html"), len(stack)))
        _, said, inside, forms = stack[-1] if stack else ("", 0.0, False, ())
        score, main, around = part_score(tag, m[3], inside)
        serial += 1
        stack.append((tag, said + score, inside or main, (*forms, serial) if around or tag in ("form", "fieldset") else forms))
        opened[tag] += 1
        if tag in BLOCK:
            boxes.append((serial, tag))
        unseen += tag in UNSEEN
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            pop_to(len(stack) - 1)
            at = end.end() if end else len(page)
    pop_to(0)
    flush()
    held: Counter[int] = Counter()
    for b in out:
        for f in b.forms:
            held[f] += len(b.text)
    whole = sum(len(b.text) for b in out)
    for b in out:
        b.parts += AWAY * any(2 * held[f] <= whole for f in b.forms)
    if not serial:  # no element at all: the page is its text
        for b in out:
            b.parts -= AWAY
    with_siblings(out)
    return out


def with_siblings(blocks: list[Block]) -> None:
    """Set the last feature: how much of the text of the other blocks below the same element is linked."""
    links, chars = Counter[int](), Counter[int]()
    for b in blocks:
        links[b.parent] += b.linked
        chars[b.parent] += len(b.text)
    for b in blocks:
        others = chars[b.parent] - len(b.text)
        b.features = (*b.features[:-1], (links[b.parent] - b.linked) / others if others else 0.0)


def ties(blocks: list[Block], strength: float) -> Iterator[tuple[int, int, float]]:
    """Smoothness edges: neighbours in the page, and next children of the same parent."""
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            yield i - 1, i, strength * 2.0 ** (1 - min(64, blocks[i - 1].depth + b.depth - 2 * b.shared))
        if (j := last.get(b.parent)) is not None and j < i - 1:
            yield j, i, strength / 2
        last[b.parent] = i


def min_cut(capacity: list[float], edges: Iterator[tuple[int, int, float]]) -> list[bool]:
    """Whether each node stays with the source. capacity: from the source if positive, to the sink if negative."""
    n = len(capacity)
    s, t = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(u: int, v: int, there: float, back: float) -> None:
        out[u].append(len(to))
        out[v].append(len(to) + 1)
        to.extend((v, u))
        room.extend((there, back))

    for i, c in enumerate(capacity):
        if c > 0:
            add(s, i, c, 0)
        elif c < 0:
            add(i, t, -c, 0)
    for u, v, w in edges:
        add(u, v, w, w)
    while True:
        level = {s: 0}
        todo = deque([s])
        while todo:
            u = todo.popleft()
            for e in out[u]:
                if room[e] > 1e-9 and to[e] not in level:
                    level[to[e]] = level[u] + 1
                    todo.append(to[e])
        if t not in level:
            return [i in level for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:  # augment along the levels
            if u == t:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                k = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while at[u] < len(out[u]):
                e = out[u][at[u]]
                if room[e] > 1e-9 and level.get(to[e], -1) == level[u] + 1:
                    break
                at[u] += 1
            if at[u] < len(out[u]):
                path.append(out[u][at[u]])
                u = to[path[-1]]
            elif path:
                u = to[path.pop() ^ 1]
                at[u] += 1
            else:
                break


def labelled(page: str | None, weights: tuple[float, ...] = TEXT_PRIOR, strength: float = 0.6) -> tuple[list[Block], list[bool]]:
    """The blocks of a page with their log-odds, and whether the cut leaves them on the content side."""
    blocks = blocks_of(page or "")
    for b in blocks:
        b.score = b.parts + sum(w * x for w, x in zip(weights, b.features, strict=True))
    return blocks, min_cut([b.score for b in blocks], ties(blocks, strength))


def main_text(page: str | None, weights: tuple[float, ...] = TEXT_PRIOR, strength: float = 0.6) -> str:
    blocks, kept = labelled(page, weights, strength)
    return "\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)


def weak_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and weak label of the blocks whose part of the page says what they are."""
    for batch in batches:
        rows, labels = [], []
        for v in batch.column(0):
            for b in blocks_of(v.as_py() or ""):
                if b.parts >= IN_MAIN or b.parts <= AWAY:
                    rows.append(b.features)
                    labels.append(float(b.parts > 0))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.float64())], ["x", "y"])


def newton_batches(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of the gradient and of the curvature of the log-likelihood, one number a row."""
    k = len(weights)
    sums = np.zeros(k + k * k)
    for batch in batches:
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        y = batch.column(1).to_numpy(zero_copy_only=False)
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        sums[:k] += x.T @ (y - p)
        sums[k:] += ((x * (p * (1 - p))[:, None]).T @ x).ravel()
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums, pa.float64())], ["i", "v"])


def fit(pages: DataFrame, fit_pages: int = 5000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[float, ...]:
    """Weights of the text features, fitted on the weak labels of about fit_pages pages."""
    ship(pages.sparkSession)
    n = max(1, pages.count())
    drawn = F.pmod(F.xxhash64(pages[id_col], pages[url_col]), F.lit(1 << 30)) < int((1 << 30) * min(1.0, fit_pages / n))
    sample = cut(pages.filter(drawn).select(pages[html_col].alias("html")).mapInArrow(weak_batches, "x array<double>, y double"), "weak-labels")
    prior = np.array(TEXT_PRIOR)
    weights, k = prior.copy(), len(prior)
    precision = max(PRIOR_BLOCKS, PRIOR_SHARE * sample.count()) / 4
    for _ in range(FIT_STEPS):
        now = weights.copy()
        sums = np.zeros(k + k * k)
        for r in sample.mapInArrow(lambda b, w=now: newton_batches(b, w), "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # k + k * k numbers
            sums[r.i] = r.v
        gradient = sums[:k] - precision * (weights - prior)
        weights = weights + np.linalg.solve(sums[k:].reshape(k, k) + precision * np.eye(k), gradient)
        if np.abs(weights - now).max() < 1e-4:
            break
    drop_table(pages.sparkSession, sample)
    return tuple(weights.round(4).tolist())


def extract_batches(batches: Iterator[pa.RecordBatch], weights: tuple[float, ...], strength: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(v.as_py(), weights, strength) for v in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, strength: float = 0.6, fit_pages: int = 5000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, the main text of each whole page, and its code points. fit_pages 0: the prior's weights."""
    ship(pages.sparkSession)
    weights = fit(pages, fit_pages, id_col, url_col, html_col) if fit_pages else TEXT_PRIOR
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return rows.mapInArrow(lambda b: extract_batches(b, weights, strength), "page_id long, url string, text string, n_chars long")
