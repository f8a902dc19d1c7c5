"""SimHash classes against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash
from millrace.llm.components import components
from millrace.llm.simhash import allocate, bucket_links, fingerprint, links, near_duplicates


def slow_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_classes(fps):
    """fps: {node: fingerprint}; the least node of each class."""
    root = {n: n for n in fps}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in fps}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_of_odd_texts():
    for t in (None, "", " \n", "one", "Two WORDS É", "a b c d e", "x " * 300 + "Y\x1cz", "é à ü " * 50, " ".join(f"w{i % 977}" for i in range(66_000))):
        assert fingerprint(t) == slow_fingerprint(t)
    assert fingerprint("") == 0


def test_thresholds_take_the_cheapest_sum():
    cost, ts = allocate([[0, 5, 50], [0, 1, 2], [0, 1, 9]], 0)
    assert sum(ts) == 0 and (cost, ts) == (3, [-1, 1, 0])


@pytest.mark.parametrize("block", [8, 2048])
def test_links_reach_every_pair(spark, block):
    r = random.Random(11)
    fps = []
    for _ in range(60):  # clusters, chains and lone ones
        x = r.getrandbits(64)
        fps.append(x)
        for _ in range(r.choice([0, 0, 1, 3, 12])):
            for b in r.sample(range(64), r.randint(1, 5)):
                x ^= 1 << b
            fps.append(x)
    base = r.getrandbits(64)
    fps += [base ^ (1 << i) ^ (1 << j) for i, j in combinations(range(14), 2)]
    nodes = dict(enumerate(dict.fromkeys(fps)))
    df = spark.createDataFrame([(signed(f), n) for n, f in nodes.items()], "fp long, node long")
    found = links(df, 4, block)
    assert all((nodes[e.a] ^ nodes[e.b]).bit_count() <= 4 for e in found.collect())
    got = {n: n for n in nodes} | {e.node: e.root for e in components(found, "a", "b").collect()}
    assert got == slow_classes(nodes)


def test_bucket_keeps_a_forest():
    x = np.array([0] + [1 << i for i in range(64)] * 20, np.uint64)
    assert len(bucket_links(x, 4)) == len(x) - 1


def test_near_duplicates_of_documents(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(40):
        t = [r.choice(words) for _ in range(r.choice([3, 60, 700]))]
        rows.append((i * 3, " ".join(t)))
        if i % 3 == 0:
            rows.append((i * 3 + 1, " ".join(t).upper()))
            t[len(t) // 2] = "changed"
            rows.append((i * 3 + 2, "\n".join(t)))
    rows += [(900, None), (901, ""), (902, " \t"), (None, "lonely text without id"), (903, "lonely text without id"), (903, "lonely text without id")]
    df = spark.createDataFrame([(*x, "c", "d") for x in rows], "doc_id long, text string, component_id string, fp string").repartition(5)
    got = near_duplicates(df).collect()
    fps = {d: slow_fingerprint(t) for d, t in rows if d is not None}
    want = slow_classes(fps)
    assert len(got) == len(rows)
    for x in got:
        if x.doc_id is None:
            assert x.component_id == 903
        else:
            assert (x.fingerprint, x.component_id) == (f"{fps[x.doc_id]:016x}", want[x.doc_id])
    assert near_duplicates(df.limit(0)).count() == 0
    assert [x.component_id for x in near_duplicates(df.filter("doc_id is null")).collect()] == [None]


def test_rows_without_id_and_repeated_ids(spark):
    """Rows are what is linked: those without an id bridge others, and an id by itself links nothing."""
    r = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    texts = [[r.choice(words) for _ in range(400)] for _ in range(12)]
    rows = []
    for i, t in enumerate(texts):
        for k in range(8):  # a chain, of which some rows have no id
            rows.append((None if (i + k) % 3 == 0 else r.randrange(60), " ".join(t)))
            for _ in range(2):
                t[r.randrange(len(t))] = r.choice(words)
    fps = [fingerprint(t) for _, t in rows]
    root = slow_classes(dict(enumerate(fps)))
    root = {i: next(root[j] for j in range(len(fps)) if fps[j] == fps[i]) for i in root}
    least = {c: min((d for i, (d, _) in enumerate(rows) if root[i] == c and d is not None), default=None) for c in set(root.values())}
    want = sorted((str(d), f"{fps[i]:016x}", str(least[root[i]])) for i, (d, _) in enumerate(rows))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((str(x.doc_id), x.fingerprint, str(x.component_id)) for x in got) == want
    a, b, c = (" ".join(t) for t in texts[:3])
    got = near_duplicates(spark.createDataFrame([(3, a), (7, a), (7, b), (9, b), (None, c)], "doc_id long, text string")).collect()
    assert sorted((str(x.doc_id), str(x.component_id)) for x in got) == [("3", "3"), ("7", "3"), ("7", "7"), ("9", "7"), ("None", "None")]


def test_frequent_fingerprints_meet_rare_ones(spark, monkeypatch):
    """With and without broadcast the classes are the same."""
    import millrace.llm.common as c

    rows = [(i, "the same text of some words") for i in range(40)] + [(100 + i, f"word{i} " * 9) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, near_duplicates(df).collect()))
    for often in (10, 0):
        monkeypatch.setattr(c, "OFTEN", often)
        assert sorted(map(tuple, near_duplicates(df).collect())) == want


def test_hubs_are_kept_out_of_the_join(spark, monkeypatch):
    import millrace.llm.components as c

    monkeypatch.setattr(c, "HUB", 3)
    edges = [(1, k) for k in range(2, 40)] + [(100, k) for k in range(39, 60)] + [(200, 201), (201, 202), (7, 7), (None, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {k: 1 for k in [*range(1, 60), 100]} | {200: 200, 201: 200, 202: 200}


@pytest.mark.parametrize(("keys", "cells"), [(10_000, 1_000_000), (1, 1_000_000), (1, 0)])
def test_hot_buckets_are_dealt_whole(spark, keys, cells, monkeypatch):
    """Every pair of a bucket meets in some run, no run holds a whole hot bucket, and cold ones stay as they are."""
    monkeypatch.setattr(simhash, "CELLS", cells)
    sizes = {(0, 5): 90, (1, 5): 40, (0, 6): 17, (0, 7): 16, (3, -1): 1}
    rows = [(p, k, i, 100 * i + p) for (p, k), n in sizes.items() for i in range(n)]
    got = simhash.dealt(spark.createDataFrame(rows, "part int, key long, fp long, node long"), 16, len(rows), keys).collect()
    runs = {}
    for r in got:
        runs.setdefault((r.part, r.key, r.pair), set()).add(r.node)
    for (p, k), n in sizes.items():
        own = [v for (a, b, _), v in runs.items() if (a, b) == (p, k)]
        assert set.union(*own) == {100 * i + p for i in range(n)}
        assert all(any({100 * i + p, 100 * j + p} <= v for v in own) for i in range(n) for j in range(i))
        assert (len(own) == 1) == (n <= 16) and (n < 40 or max(map(len, own)) < n)
