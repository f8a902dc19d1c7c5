"""Spelling variants against brute force over all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from millrace.llm.queries import op11_spelling_variants
from millrace.llm.spelling import near_words, spelling_variants


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def slow_words(rows, one_in):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = lowered(run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if one_in and h % one_in == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def edits(w):
    letters = set("abcdefghijklmnopqrstuvwxyz") | {chr(c) for c in range(0xC0, 0x100)}
    for i in range(len(w) + 1):
        yield w[:i] + w[i + 1 :]
        for c in letters:
            yield w[:i] + c + w[i:]
            yield w[:i] + c + w[i + 1 :]


def slow(rows, one_in=None):
    words, out, form = slow_words(rows, one_in), {}, {}
    for w, n in words.items():
        near = {x for x in edits(w) if x in words} - {w}
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        out[w] = [n, len(near), form[w], words[form[w]] if form[w] else None]
    for w in words:
        end = w
        while form[end]:
            end = form[end]
        out[w].append(end)
    return sorted((w, *v) for w, v in out.items())


def got(df):
    assert df.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(tuple(r) for r in df.collect())


def planted(r):
    stems = ["".join(r.choice("abÄéz") for _ in range(r.choice([5, 6, 7, 9, 14]))) for _ in range(60)]
    rows = []
    for i in range(400):
        words = []
        for _ in range(r.choice([1, 20, 60])):
            w = stems[min(r.randrange(60), r.randrange(60))]
            if r.random() < 0.3:
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + "q" + w[k:], w[:k] + "q" + w[k + 1 :], w.upper(), w[0] + w])
            words.append(w)
        rows.append((i, r.choice([" ", "-", "\n", "1", "一", "Ā"]).join(words)))
    return [*rows, *rows[:50], (None, rows[0][1]), (7, None), (8, ""), (9, " \n"), (10, "ab" * 20_000), (11, "abaaba " * 30_000)]


@pytest.mark.parametrize("block", [4, 20_000])
def test_planted_words_equal_brute_force(spark, block):
    rows = planted(random.Random(2))
    df = spark.createDataFrame([(*x, "c", 1) for x in rows], "doc_id long, text string, word string, n int").repartition(3)
    assert got(spelling_variants(df, block=block, one_in=3)) == slow(rows, 3)
    assert got(spelling_variants(df, block=block)) == slow(rows)
    assert got(spelling_variants(df.limit(0))) == []


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = got(op11_spelling_variants(spark, sf))
    assert found == slow(rows, 199) and any(r[3] for r in found)


@pytest.mark.parametrize("block", [3, 50])
def test_every_near_pair_is_found_once(spark, block):
    """Repeated letters, edits at either end and in the middle, hot anchors in one and in several blocks."""
    r = random.Random(block)
    words = {"".join(r.choice("ab") for _ in range(r.choice([6, 7, 8]))) for _ in range(220)} | {"aaa" + x + "bbb" for x in "cdefgé"} | {"aaaaaa", "aaaaaaa", "aaaaaaaa"}
    found = Counter((x.word, x.near) for x in near_words(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), block=block).collect())
    assert found == Counter((w, x) for w in words for x in {*edits(w)} & words - {w})


def test_chains_of_forms(spark):
    words = ["abcdef", "abcdeff", "abcdefff", "abcdeffff"]
    rows = [(1, " ".join(w for k, w in enumerate(words) for _ in range(5 * 5**k)))]
    found = {r.word: (r.form, r.root) for r in spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {w: (words[k + 1] if k < 3 else None, words[3]) for k, w in enumerate(words)}
    with pytest.raises(ValueError):
        spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), least=5)
