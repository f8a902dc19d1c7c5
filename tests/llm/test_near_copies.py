"""Near copies against brute force over all pairs of shingle sets."""

import random
import re
from itertools import combinations

import corpus_pipeline as cp
import pytest

from millrace.llm.near_copies import near_copies


def slow_set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def slow_classes(rows):
    """rows: (id, text); the least id of each row's class."""
    sets, root = [slow_set(t) for _, t in rows], list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] == sets[b] or 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(rows))]


def planted(r):
    words, rows = [f"w{i}" for i in range(900)], []
    for _ in range(60):
        t = [r.choice(words) for _ in range(r.choice([3, 12, 60, 60, 300]))]
        rows.append(" ".join(t))
        for edits in r.choice([(), (1,), (1, 2), (1, 1, 3, 4)]):
            u = list(t)
            for _ in range(max(1, edits * len(t) // 60)):
                u[r.randrange(len(u))] = r.choice(words)
            rows.append(r.choice([" ", "\n"]).join(u))
            t = r.choice([t, u])  # stars and chains
    hub = [r.choice(words) for _ in range(100)]
    rows += [" ".join(hub[:i] + [f"x{i}"] + hub[i + 1 :]) for i in range(0, 100, 2)]
    rows += [rows[0].upper(), None, "", " \t"]
    ids = r.sample(range(10_000), len(rows))
    return [*zip(ids, rows, strict=True), (ids[1], rows[5])]


@pytest.mark.parametrize("block", [4, 2048])
def test_classes_of_planted_texts(spark, block):
    rows = planted(random.Random(5))
    df = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, node string").repartition(3)
    got = sorted((x.doc_id, x.component_id) for x in near_copies(df, block=block).collect())
    assert got == sorted(zip([d for d, _ in rows], slow_classes(rows), strict=True))
    assert near_copies(df.limit(0)).count() == 0


def test_stage_drops_what_is_eight_tenths_similar(spark, sf):
    r = random.Random(3)
    words = [f"w{i}" for i in range(900)]
    a = [r.choice(words) for _ in range(60)]
    near, far = list(a), list(a)
    near[30] = "other"  # 51 of 61 shingles
    far[20] = far[40] = "other"  # 46 of 66
    df = spark.createDataFrame([(None, "no id here at all"), (None, "No id  here at ALL"), (None, "another one"), (7, "twice"), (7, "twice"), (7, "not twice")], "doc_id long, text string").selectExpr("*", "1 AS other", "2 AS row", "3 AS own", "4 AS t", "5 AS node")
    kept = cp.near_dedup(spark, df, sf)
    assert kept.columns == df.columns and sorted((x.doc_id or 0, x.text.lower().split()[0]) for x in kept.collect()) == [(0, "another"), (0, "no"), (7, "not"), (7, "twice")]
    rows = [(1, " ".join(a)), (2, " ".join(near)), (3, " ".join(far)), (None, " ".join(near[:59])), (None, " ".join(near[:58]))]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [x.doc_id for x in cp.near_dedup(spark, df, sf).collect()]
    assert kept == [1, 3] or kept == [3, 1]


def test_links_of_sets_join_classes():
    """Blocks of sets against a plain comparison, with classes known before and several columns of the matrix."""
    import numpy as np

    import millrace.llm.near_copies as nc

    r = random.Random(1)
    base = [r.sample(range(20_000), 300) for _ in range(4)]
    sets = [np.unique(np.array([*b[: r.randrange(200, 300)], *r.sample(range(20_000, 30_000), r.randrange(20))])) for b in base for _ in range(25)] + [np.zeros(0, np.int64)]
    counts = nc.common_counts(sets)
    assert all(counts[i, j] == len(np.intersect1d(sets[i], sets[j])) for i, j in combinations(range(len(sets)), 2))
    roots = [r.randrange(60) for _ in sets]
    for percent in (60, 80, 95):
        of = {c: c for c in roots}
        for i, j in nc.set_links(sets, roots, percent):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and of[roots[i]] != of[roots[j]]
            old, new = of[roots[j]], of[roots[i]]
            of = {c: new if d == old else d for c, d in of.items()}
        for i, j in combinations(range(len(sets)), 2):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert of[roots[i]] == of[roots[j]] or 100 * both < percent * (len(sets[i]) + len(sets[j]) - both)


@pytest.mark.parametrize("bucket", [5, 1 << 18])
def test_a_text_is_dealt_out_once_for_each_stretch(spark, monkeypatch, bucket):
    """All pairs of prints that meet are found, also with buckets dealt into blocks, from few rows for each text."""
    import numpy as np

    import millrace.llm.near_copies as nc
    from millrace.llm.simhash import plan_partitions

    r, rows = random.Random(8), []
    for _ in range(150):
        base = [r.getrandbits(64) for _ in range(4)]
        rows.append(base)
        for _ in range(r.choice([0, 0, 1, 12])):
            base = r.choice([base, rows[-1]])
            rows.append([x ^ sum(1 << k for k in {r.randrange(64) for _ in range(r.choice([1, 6, 12]))}) for x in base])
    bits = np.array(rows, np.uint64)
    df = spark.createDataFrame([(k, [nc._signed(x) for x in row]) for k, row in enumerate(rows)], "node long, prints array<long>").repartition(3)
    sent, dealt = [], nc.dealt
    monkeypatch.setattr(nc, "dealt", lambda df, *x: sent.append(df.count()) or dealt(df, *x))
    monkeypatch.setattr(nc, "_LONG", 4)
    monkeypatch.setattr(nc, "_SORTED", 500)
    found = {x.node: x.key for x in nc.clusters(df, bucket).collect()}
    plan = plan_partitions(df.selectExpr("prints[0] AS fp"), len(rows), nc.DISTANCE, nc.PLANNED)
    assert sent == [len(rows) * nc.WORDS * sum(t + 1 for _, t in plan)]
    masks = [(np.uint64(sum(1 << b for b in g)), t) for g, t in plan]
    root = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        x = bits[i] ^ bits[j]
        if np.bitwise_count(x).sum() <= nc.FARTHEST and any((np.bitwise_count(x & m) <= t).any() for m, t in masks):
            low, high = sorted((root[i], root[j]))
            root = [low if k == high else k for k in root]
    # flips of both sides may meet a bit further
    together = [k for k in range(len(rows)) if root.count(root[k]) > 1]
    assert set(together) <= found.keys() and all(found[k] == found[root[k]] for k in together)
    far = {(i, j) for i, j in combinations(found, 2) if found[i] == found[j] and root[i] != root[j]}
    assert all(np.bitwise_count(bits[[k for k in found if found[k] == found[i] and k != i]] ^ bits[i]).sum(1).min() <= nc.FARTHEST for i, _ in far)
