"""Template leaks against a brute-force version, over planted, re-parameterised and inconsistent questions."""

import random
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from millrace.llm.decontaminate import NAME, NAMES, NUMBER, NUMBERS, PUNCTUATION, UNIT, UNITS, clean, leaks, with_ids, with_templates

ITEM = "A farmer sells 12 apples for $3.50 and then buys 7 km of rope from old Peter, how many apples and how much rope are left after Peter returns 7 km of it?"
SAME = "A farmer sells 40 apples for $9.25 and then buys 8 km of rope from old Maria, how many apples and how much rope are left after Maria returns 8 km of it?"
BROKEN = "A farmer sells 40 apples for $9.25 and then buys 8 km of rope from old Maria, how many apples and how much rope are left after Ivan returns 6 km of it?"
SHORT = "tiny but exact question"
SERIES = "1 4 9 16 25 36 49 64 81 100 121 144 169 what comes next"
OPENING = "Tom has 5 red pens. Sue has 3 more pens than Tom. How many pens do they have?"
RENAMED = "Max has 4 red pens. Eve has 9 more pens than Max. How many pens do they have?"
ITEMS = [(1, ITEM), (2, SHORT), (3, None), (4, ""), (5, ITEM), (6, SERIES), (7, OPENING), (8, "another text of the"), (8, "same item with two texts")]
NOISE = " ".join(f"filler{i}" for i in range(300))


def slow_tokens(text):
    words = [x for x in regex.sub(r"[\t\n\x0b\x0c\r]", " ", text or "").translate(str.maketrans("", "", PUNCTUATION)).split(" ") if x]
    number = [bool(regex.search(NUMBERS, w)) for w in words]
    plain = [NUMBER if n else UNIT if i and number[i - 1] and w.lower() in UNITS else w.lower() for i, (w, n) in enumerate(zip(words, number, strict=True))]
    return [[w.lower() for w in words], plain, [NAME if regex.search(NAMES, w) and p != UNIT else p for w, p in zip(words, plain, strict=True)]]


def slow_leaks(text, item, size=8, need=6):
    """Windows of the item on the best alignment, or 0 where they are too few."""
    (dr, dp, dq), (ir, ip, iq) = slow_tokens(text), slow_tokens(item)
    k = min(size, len(ir))
    if not k:
        return 0
    best, n = 0, len(ir) - k + 1
    literal = lambda w: 2 * sum(not x.startswith("‹") for x in w) >= k
    for shift in range(-len(ir), len(dr)):
        hit = set()
        for at in range(n):
            p = at + shift
            if p < 0 or p + k > len(dr):
                continue
            one = dp[p : p + k] == ip[at : at + k] if literal(ip[at : at + k]) else dr[p : p + k] == ir[at : at + k]
            two = literal(iq[at : at + k]) and dq[p : p + k] == iq[at : at + k] and iq[at : at + k] != ip[at : at + k]
            if one or two:
                hit.add(at)
        if len(hit) < min(need, n):
            continue
        slots = {i for at in hit for i in range(at, at + k) if iq[i].startswith("‹")}
        votes = Counter((iq[i], ir[i], dr[i + shift]) for i in slots)
        odd = set()
        for of in (1, 2):
            groups = {}
            for v, c in votes.items():
                groups.setdefault((v[0], v[of]), []).append((-c, v[1], v[2]))
            odd |= {(g[0], *x[1:]) for g, vs in groups.items() for x in sorted(vs)[1:]}
        good = [at for at in hit if not any((iq[i], ir[i], dr[i + shift]) in odd for i in slots if at <= i < at + k)]
        if len(good) >= min(need, n):
            best = max(best, len(good))
    return best


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, item_id long, t string, leaking int").repartition(3)


def test_templates_keep_positions(spark):
    df = spark.createDataFrame([("We paid 1,200.50 dollars to Anna, 5 KM\noff. Then 3.5, and $7!",), ("No digits",), ("",), ("9",), ("\x85 ÉTÉ Été 5 Km",)], "t string")
    for r in with_templates(df, "t").collect():
        assert [r.raw, r.plain, r.names] == slow_tokens(r.t)
    assert with_templates(df, "t").first().names == "‹c› paid ‹n› ‹u› to ‹c› ‹n› ‹u› off ‹c› ‹n› and ‹n›".split()
    ids = with_ids(with_templates(df.withColumnRenamed("t", "text")).withColumnsRenamed({"raw": "r", "plain": "p", "names": "q"}), {"raw", "names"})
    same = [F.transform(w, lambda x: F.xxhash64(x)) == F.col(i) for w, i in zip("rpq", ("raw", "plain", "names"), strict=True)]
    assert ids.filter(same[0] & same[1] & same[2]).count() == df.count()


ROWS = [
    (10, NOISE), (11, f"{NOISE} {ITEM.upper()} {NOISE}"), (12, f"{NOISE}\n{SAME}\n{NOISE}"), (13, None), (14, ""), (15, f"so {SHORT} it is"),
    (16, ITEM.split(" from ")[0]), (17, "A farmer sells 12 apples for $3.50 and"), (12, "repeated id"), (None, ITEM), (18, ITEM + " " + ITEM),
    (19, ITEM.lower()), (20, ITEM.replace(" ", "\n")), (21, ITEM.replace(" Peter", " \n\t Peter")), (22, RENAMED), (23, f"{NOISE}. {RENAMED} {NOISE}"),
    (24, SERIES), (25, f"x {SERIES} y"), (26, BROKEN), (27, SAME.title()), (28, "same item with two texts"), (29, NOISE * 40 + " " + SAME + " " + NOISE * 40),
    (1, SAME), (1, SAME.replace("40", "77").replace("Maria", "Olga").replace(" 8 ", " 5 ")),
]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_leaks_equal_brute_force(spark, items, limit):
    r = random.Random(9)
    numbers = " ".join(str(r.randrange(10_000)) for _ in range(3000))
    rows = [*ROWS, (30, numbers), (31, " ".join(f"Name{c}" for c in "abc" * 50))]
    want = {}
    for d, text in rows:
        for i, item in ITEMS:
            if m := slow_leaks(text if text != numbers else numbers[:2000], item or ""):
                want[d, i] = max(m, want.get((d, i), 0))
    got = {(x.doc_id, x.item_id): x.matched for x in leaks(frame(spark, rows), items, broadcast_windows=limit).collect()}
    assert got == want
    found = {d for d, _ in got}
    assert {11, 12, 15, 16, 18, 19, 20, 21, 22, 23, 24, 25, 28, 29, 1, None} <= found and not {10, 13, 14, 17, 30, 31} & found


def test_inconsistent_slots_count_for_less(spark, items):
    got = {r.doc_id: r.matched for r in leaks(frame(spark, [(1, SAME), (2, BROKEN)]), items).filter("item_id = 1").collect()}
    assert got[1] > got[2]


def test_clean_documents_stay(spark, items):
    df = frame(spark, [(10, NOISE), (12, SAME), (None, ITEM), (14, None), (12, "kept though its id leaks elsewhere"), (10, NOISE)])
    kept = clean(df, items)
    assert kept.columns == df.columns and sorted((r.doc_id, (r.text or "")[:4]) for r in kept.collect()) == [(10, "fill"), (10, "fill"), (12, "kept"), (14, "")]
    assert leaks(df.limit(0), items).count() == 0 and leaks(df, items.limit(0)).count() == 0
    assert clean(df, items.limit(0)).count() == 6
