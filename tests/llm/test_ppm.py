"""PPM and unigram scores against plain loops, and held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm.ppm import kinds_of, lm_scores


def is_held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def plain_scores(rows, most=4):
    """(id, held_out, tokens, known, N, base, score) of each row, one symbol at a time."""

    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]

    words, tries = Counter(), {}
    for i, t in rows:
        if not is_held_out(i):
            words.update(tokens(t))
            data = b"\xff" * most + (t or "").encode() + b"\xff"
            for k in range(most, len(data)):
                for order in range(most + 1):
                    tries.setdefault(data[k - order : k], Counter())[data[k]] += 1
    n, v = sum(words.values()), len(words)

    def log_p(context, symbol):
        p, out = 1.0, set()
        for order in range(most, -1, -1):
            counts = {s: c for s, c in tries.get(context[most - order :], {}).items() if s not in out}
            total, d = sum(counts.values()), len(counts)
            if d:
                if symbol in counts:
                    return math.log10(p * counts[symbol] / (total + d))
                p *= d / (total + d)
                out |= set(counts)
        return math.log10(p / (256 - len(out)))

    result = []
    for i, t in rows:
        ts = tokens(t)
        data = b"\xff" * most + (t or "").encode() + b"\xff"
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts)
        result.append((i, is_held_out(i), len(ts), sum(words[w] > 0 for w in ts), n, base, sum(log_p(data[k - most : k], data[k]) for k in range(most, len(data)))))
    return result


ROWS = [(i, f"The cat {i % 5} sat on\x0bthe mat, été {'x' * (i % 7)}\n" * (i % 3 + 1)) for i in range(60)]
ROWS += [(100, None), (101, ""), (102, " \t\n"), (None, "no id"), (103, "the \x1c\x85 zzz \U0001f600"), (7, "same id, other text"), (8, ROWS[8][1]), (104, "long " * 30_000)]


@pytest.mark.parametrize("frequent, codes, order", [(1, 1, 4), (20, 50, 4), (1_000_000, 4_000_000, 4), (20, 200, 6), (1, 1, 1)])
def test_scores_equal_plain_loops(spark, frequent, codes, order):
    df = spark.createDataFrame([(*r, "a", 1.0) for r in ROWS], "doc_id long, text string, word string, score double").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted(map(tuple, lm_scores(df, frequent=frequent, frequent_codes=codes, order=order).collect()), key=key)
    want = sorted(plain_scores(ROWS, order), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


def test_empty_tables(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert lm_scores(df.limit(0)).count() == 0
    alone = next(i for i in range(200, 400) if is_held_out(i))
    one = spark.createDataFrame([(alone, "ab")], "doc_id long, text string")
    r = lm_scores(one).collect()[0]
    assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 2) and r.score == pytest.approx(-3 * math.log10(256), rel=1e-6)


def test_held_out_documents_are_predicted(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = lm_scores(df).filter("held_out").collect()
    size = {r.doc_id: len(r.text.encode()) + 1 for r in df.collect()}
    bits = -sum(r.score for r in rows) * math.log2(10) / sum(size[r.doc_id] for r in rows)
    assert rows and bits < 3.2  # uniform bytes: 8
    shallow = lm_scores(df, order=2).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.score for r in shallow)


def test_kinds_are_those_of_unique():
    rng = np.random.default_rng(3)
    for values in (rng.integers(0, 40, 1000) << 30, np.zeros(0, np.int64), np.array([7, -1, 7, 1 << 39], np.int64)):
        kinds, at = kinds_of(values)
        want, places = np.unique(values, return_inverse=True)
        assert kinds.tolist() == want.tolist() and at.tolist() == places.tolist() and kinds.dtype == values.dtype
