"""SimHash near-dedup by similarity: candidates by SimHash, verified on the word-shingle sets.

Two texts are linked if the Jaccard similarity of their sets of 5-word shingles is `percent` or more;
classes are the components of the links. One 64-bit fingerprint can't reach so far: at similarity 0.8
two fingerprints differ in 15 % of their bits, 10 of 64 with a spread of 3. So WORDS independent ones
are taken, each searched by the generalised pigeonhole of `simhash` for DISTANCE bits. With three
partitions of 21 bits at threshold 2 a pair at 0.8 meets in one word with a chance of 0.74, so all WORDS
miss it with a chance of 0.005, and one above 0.8 with less. Every candidate is verified on the sets
themselves before it is linked.

1. texts with equal sets are one node, named by a hash of the set, so exact copies cost no pairs;
2. two nodes with at most t differing bits in a partition agree in one of its t + 1 stretches. So a node is dealt
   out once for each stretch, 36 times, and not once for each flipped key, 264 times; a task holds the bucket of a
   stretch (1 in 128 nodes) and flips the other bits in memory. Nodes that meet are compared on all their fingerprints together
   (FARTHEST bits, which no chance pair comes near), a bucket keeps a spanning forest, and the components of
   these links are the candidates: each node is in one;
3. in each component one node is verified with all others, twice with another node in turn; a component
   whose nodes are all in one class is done, so k near copies cost about k comparisons and not k * k;
4. in the components left, the sets of each pair of blocks meet in a task, which counts the shingles common to
   all its pairs at once (a matrix product) and keeps a spanning forest of the links. No pairs are written.

Sets are rebuilt only for documents with a candidate. A node with more than `block` pairs meets them
in several parts.

Edge cases: null and blank texts have equal (empty) sets; a text of fewer words than a shingle is one
shingle; a row without an id is compared like any other, and its class is null only if no row of it has
an id; an id with several texts has several rows; ties are one class whatever their order; very long texts are hashed piece by piece; an empty table
gives an empty table; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, look_up, ship
from millrace.llm.components import components
from millrace.llm.simhash import SEED, apart, bucket_links, dealt, flips, majority, plan_partitions, shingle_hashes

#: Fingerprints of a text, the bits that each is searched for, and the most bits between candidates in all of them.
WORDS, DISTANCE, FARTHEST = 4, 8, 64
#: Sets of a block that are compared in a task; texts that the partitions are planned for at least; rows of a bucket that a task holds.
BLOCK, PLANNED, BUCKET = 512, 10_000_000, 1 << 18


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of the text's word shingles."""
    parts = [np.unique(h) for h in shingle_hashes(text, size)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def remixed(h: np.ndarray, word: int) -> np.ndarray:
    """Independent hashes from hashes (the finaliser of a 64-bit mixer)."""
    x = h + np.uint64(0x9E3779B97F4A7C15 * (word + 1) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _name(found: np.ndarray) -> int:
    return _signed(xxhash.xxh64_intdigest(found.tobytes(), SEED))


def prints_of(found: np.ndarray) -> list[int]:
    """The fingerprints of a set of hashes."""
    pieces = [found[i : i + (1 << 16)] for i in range(0, len(found), 1 << 16)]
    return [_signed(majority(remixed(h, k) for h in pieces)) for k in range(WORDS)]


def signature_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, prints = [], []
        for v in batch.column(1):
            found = shingles(v.as_py(), size)
            names.append(_name(found))
            prints.append(prints_of(found))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.int64()), pa.array(prints, pa.list_(pa.int64()))], ["row", "node", "prints"])


def stretches(group: list[int], n: int) -> list[list[int]]:
    """n stretches of near-equal width that the bits of a group are cut into."""
    return [x.tolist() for x in np.array_split(np.array(group), n)]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least position that each of n positions reaches over the pairs."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            return root
        a, b = a[differ], b[differ]
        np.minimum.at(root, np.maximum(x, y)[differ], np.minimum(x, y)[differ])
        while (root[root] != root).any():
            root = root[root]


#: Keys of a task that are sorted at a time; runs of equal keys up to this long are compared many at a time; pairs kept before a forest is made of them.
_SORTED, _LONG, _PAIRS = 1 << 20, 64, 1 << 20


def near_pairs(keys: np.ndarray, fp: np.ndarray, masks: np.ndarray, distance: int) -> np.ndarray:
    """The least position that each row reaches over pairs of at most `distance` bits. Compared are the rows that share one of
    their keys, which are `keys` with the bits of one mask flipped. fp: rows of fingerprints."""
    root = np.arange(len(keys))
    turns = len(keys) * len(masks) // _SORTED + 1
    for turn in range(turns):
        parts = []
        for m in masks:
            mixed = remixed(keys ^ m, 0)
            at = np.flatnonzero(mixed % np.uint64(turns) == np.uint64(turn)) if turns > 1 else np.arange(len(keys))
            parts.append((mixed[at], at))
        mixed, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(mixed)
        mixed, at = mixed[order], at[order]
        starts = np.flatnonzero(np.append(True, mixed[1:] != mixed[:-1]))
        sizes = np.diff(np.append(starts, len(mixed)))
        for k in np.flatnonzero(sizes > _LONG).tolist():
            run = at[starts[k] : starts[k] + sizes[k]]
            if (root[run] != root[run[0]]).any() and (pairs := bucket_links(fp[run], distance)):
                x, y, _ = np.array(pairs).T
                root = forest(len(root), np.concatenate([root, run[x]]), np.concatenate([np.arange(len(root)), run[y]]))
        left = np.repeat(np.where(sizes > _LONG, 0, sizes - 1), sizes) - (np.arange(len(at)) - np.repeat(starts, sizes))
        here, a, b, n = np.flatnonzero(left > 0), [], [], 0
        for d in range(1, _LONG):
            if not len(here):
                break
            x, y = at[here], at[here + d]
            differ = root[x] != root[y]
            x, y = x[differ], y[differ]
            close = apart(fp[x], fp[y]) <= distance
            a.append(x[close]), b.append(y[close])
            n += len(a[-1])
            here = here[left[here] > d]
            if n > _PAIRS or not len(here):
                root = forest(len(root), np.concatenate([root, *a]), np.concatenate([np.arange(len(root)), *b]))
                a, b, n = [], [], 0
    return root


def near_batches(batches: Iterator[pa.RecordBatch], searched: list[tuple[int, int, int]], distance: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join the near nodes of each bucket, from rows (part, key, pair, fp, node) in bucket order.

    searched: of each part the word, the bits that are free in its buckets, and how many of them may be flipped."""

    def linked(columns: list[np.ndarray]) -> pa.RecordBatch:
        part, key, pair, fp, node = columns
        fp, found = fp.view(np.uint64), []
        # nodes of two buckets that meet by chance do no harm, since all bits are compared
        bucket = remixed(remixed(key.view(np.uint64), 1) + pair.view(np.uint64), 2)
        for i in np.unique(part).tolist():
            own = np.flatnonzero(part == i)
            word, free, most = searched[i]
            bits = [k for k in range(64) if free >> k & 1]
            masks = np.array([0, *flips(bits, most)], np.int64).view(np.uint64)
            keys = (fp[own, word] & np.uint64(free)) ^ (bucket[own] & ~np.uint64(free))
            root = near_pairs(keys, fp[own], masks, distance)
            more = np.flatnonzero(root != np.arange(len(root)))
            found.append((node[own[more]], node[own[root[more]]]))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        differ = a != b
        return pa.RecordBatch.from_arrays([pa.array(a[differ], pa.int64()), pa.array(b[differ], pa.int64())], ["a", "b"])

    def column(c: pa.Array) -> np.ndarray:
        return c.flatten().to_numpy().reshape(len(c), -1) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False)

    def joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*parts, strict=True)]

    rest: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [column(c) for c in batch.columns]
        before = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]) | (now[2] != now[2][-1]))
        last = int(before[-1]) + 1 if len(before) else 0  # where the batch's last bucket begins
        if last or rest and any(x[-1] != y[0] for x, y in zip(rest[-1][:3], now[:3], strict=True)):
            yield linked(joined([*rest, [x[:last] for x in now]]))
            rest = []
        rest.append([x[last:] for x in now])
    if rest:
        yield linked(joined(rest))


def set_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            sets = [shingles(v.as_py(), size) for v in batch.column(0).slice(i, 256)]
            yield pa.RecordBatch.from_arrays([pa.array(map(_name, sets), pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "found"])


#: Shingle hashes of a block of sets, and columns of the matrix of which two blocks are multiplied at a time.
_HASHES, _COLUMNS = 1 << 20, 1 << 12


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes each pair of sets has in common."""
    owner = np.repeat(np.arange(len(sets)), [*map(len, sets)])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    shared = times[column] > 1
    owner, column = owner[shared], rank[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    found = np.zeros((len(sets), len(sets)), np.float32)
    for k in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        i, j = np.searchsorted(column, [k, k + _COLUMNS])
        part = np.zeros((len(sets), _COLUMNS), np.float32)
        part[owner[i:j], column[i:j] - k] = 1
        found += part @ part.T
    return found


def set_links(sets: list[np.ndarray], roots: list[int], percent: int) -> list[tuple[int, int]]:
    """Pairs of positions that join the classes `roots` of sets by the links between them."""
    class_of = {r: r for r in roots}

    def find(r: int) -> int:
        while class_of[r] != r:
            class_of[r] = r = class_of[class_of[r]]
        return r

    both, sizes, out = common_counts(sets), np.array([*map(len, sets)]), []
    names = np.unique(roots, return_inverse=True)[1]
    for i in range(len(sets) - 1):
        near = 100 * both[i, i + 1 :] >= percent * (sizes[i] + sizes[i + 1 :] - both[i, i + 1 :])
        for j in (np.flatnonzero(near & (names[i + 1 :] != names[i])) + i + 1).tolist():
            x, y = find(roots[i]), find(roots[j])
            if x != y:
                class_of[y] = x
                out.append((i, j))
    return out


def verify_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between the classes of each run of rows (key, pair, node, root, found)."""
    rows = ((k, p, n, r, s) for b in batches for k, p, n, r, s in zip(*(c.to_pylist() for c in b.columns[:4]), b.column(4), strict=True))
    for _, run in groupby(rows, key=lambda r: r[:2]):
        _, _, nodes, roots, found = map(list, zip(*run, strict=True))
        if len(set(roots)) > 1:
            pairs = set_links([s.values.to_numpy() for s in found], roots, percent)
            yield pa.RecordBatch.from_arrays([pa.array([nodes[k] for k in side], pa.int64()) for side in (zip(*pairs, strict=True) if pairs else ((), ()))], ["a", "b"])


def verified_inside(rows: DataFrame, sets: DataFrame, percent: int, block: int, hashes: int = _HASHES) -> DataFrame:
    """Links (a, b) that join the classes of each component. rows: key, node and root of its nodes.

    A component is dealt into blocks of about `block` sets and `hashes` hashes, and each pair of blocks is a task's run.
    """
    sized = cut(rows.join(sets.select(F.col("node").alias("of_node"), F.col("found")), F.col("node") == F.col("of_node")).select("key", "node", "root", "found"), "open-sets")
    blocks = sized.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.size("found")).alias("hashes")).select(F.col("key").alias("of"), F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("hashes") / hashes), F.lit(1)).cast("long").alias("blocks"))
    met = sized.join(blocks, F.col("key") == F.col("of"))
    met = met.select("key", "node", "root", "found", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("mine"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"), "blocks")
    pair = F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")
    runs = met.select("key", pair.alias("pair"), "node", "root", "found").repartition("key", "pair").sortWithinPartitions("key", "pair")
    return runs.mapInArrow(lambda b: verify_batches(b, percent), "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int, block: int, broadcast_keys: int, broadcast_ids: int = 1_000_000) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are at least `percent` similar."""
    # a hub stands at a; each of its parts meets a copy of its set
    hot = cut(pairs.groupBy("a").count().filter(F.col("count") > block).select(F.col("a").alias("hot"), F.ceil(F.col("count") / block).alias("parts")), "hot-nodes")
    n_hot = hot.count()
    side = F.broadcast(hot) if n_hot <= broadcast_keys else hot
    one = F.lit(1).cast("long")

    def of(key: str) -> DataFrame:
        ids = cut(pairs.select(F.col(key).alias("of")).distinct(), "pair-nodes")
        ids = F.broadcast(ids) if ids.count() <= broadcast_ids else ids
        return sets.join(ids, F.col("node") == F.col("of"), "left_semi").select(F.col("node").alias(f"{key}_node"), F.col("found").alias(f"{key}_set"))

    left, right = of("a"), of("b")
    if n_hot:
        pairs = pairs.join(side, F.col("a") == F.col("hot"), "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("parts", one)).alias("part"))
        left = left.join(side, F.col("a_node") == F.col("hot"), "left").select("a_node", "a_set", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", one) - 1)).alias("a_part"))
    else:
        pairs, left = pairs.withColumn("part", one), left.withColumn("a_part", one)
    met = pairs.join(left, (F.col("a") == F.col("a_node")) & (F.col("part") == F.col("a_part"))).join(right, F.col("b") == F.col("b_node"))
    both = F.size(F.array_intersect("a_set", "b_set"))
    return met.filter(both * 100 >= percent * (F.size("a_set") + F.size("b_set") - both)).select("a", "b")


def close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that differ in at most FARTHEST bits of all their fingerprints."""
    left = nodes.select(F.col("node").alias("a_node"), F.col("prints").alias("a_prints"))
    right = nodes.select(F.col("node").alias("b_node"), F.col("prints").alias("b_prints"))
    met = pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node"))
    apart = sum((F.bit_count(F.col("a_prints")[k].bitwiseXOR(F.col("b_prints")[k])) for k in range(WORDS)), F.lit(0))
    return met.filter(apart <= FARTHEST).select("a", "b")


def links(members: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK, broadcast_keys: int = 10_000, turns: int = 2) -> DataFrame:
    """Verified pairs (a, b) that connect all similar nodes of a component of candidates.

    members: key, node; nodes: node, prints; sets: node, found.
    """
    spark = members.sparkSession
    found = spark.createDataFrame([], "a long, b long")
    labelled = members.withColumn("root", F.col("node"))
    for turn in range(turns + 1):
        pivot = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "root")).alias("pivot")
        live = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("count"), pivot)
        live = cut(live.filter("low <> high").select("key", F.col("pivot.node").alias("a"), F.col("pivot.root").alias("a_root"), "count"), "clusters")
        if live.isEmpty():
            break
        # clusters that are done have no row in live
        rest = cut(labelled.join(F.broadcast(live.select(F.col("key").alias("of"))) if live.count() <= broadcast_keys else live.select(F.col("key").alias("of")), F.col("key") == F.col("of"), "left_semi"), "open")
        if turn == turns:
            return found.union(cut(verified_inside(rest, sets, percent, block), "verified"))
        pairs = look_up(rest, live, "key", rest.count()).filter("root <> a_root").select("a", F.col("node").alias("b"))
        pairs = cut(close(pairs.distinct(), nodes), "candidates")
        found = found.union(cut(verified(pairs, sets, percent, block, broadcast_keys), "verified"))
        of = components(found, "a", "b").select(F.col("node").alias("linked"), F.col("root").alias("to"))
        labelled = cut(members.join(of, F.col("node") == F.col("linked"), "left").select("key", "node", F.coalesce("to", "node").alias("root")), "labelled")
    return found


def clusters(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """key and node of the components of candidates. nodes: node, prints."""
    n = nodes.count()
    if n < 2:
        return nodes.sparkSession.createDataFrame([], "key long, node long")
    plan = plan_partitions(nodes.select(F.col("prints")[0].alias("fp")), n, DISTANCE, PLANNED)
    # two nodes with at most t differing bits in a group agree in one of its t + 1 stretches
    searched, entries = [], []
    for word in range(WORDS):
        for group, t in plan:
            for stretch in stretches(group, t + 1):
                free = sum(1 << b for b in set(group) - set(stretch))
                key = F.col("prints")[word].bitwiseAND(F.lit(_signed(sum(1 << b for b in stretch))))
                entries.append(F.struct(F.lit(len(searched)).alias("part"), key.alias("key")))
                searched.append((word, free, (t + 1) // 2))
    rows = nodes.select("node", F.col("prints").alias("fp"), F.explode(F.array(*entries)).alias("x")).select("node", "fp", "x.*")
    linked = dealt(rows, bucket, n * len(entries)).mapInArrow(lambda b: near_batches(b, searched, FARTHEST), "a long, b long").distinct()
    return components(linked, "a", "b").select(F.col("root").alias("key"), "node")


def _key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """row: no id, id, hash of the text. The least row of a class is the one that stands for it."""
    text, key = F.coalesce(docs[text_col], F.lit("")), docs[id_col].cast("long")
    return F.struct(key.isNull().alias("nameless"), key.alias("id"), F.xxhash64(text, F.octet_length(text)).alias("t")).alias("row")


def classes(docs: DataFrame, percent: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", block: int = 2048, bucket: int = BUCKET, broadcast_ids: int = 1_000_000) -> DataFrame:
    """row and the least row of its class, for each row of docs."""
    ship(docs.sparkSession)
    rows = docs.select(_key(docs, id_col, text_col), docs[text_col].alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    signed = cut(rows.mapInArrow(lambda b: signature_batches(b, shingle), f"row {kind}, node long, prints array<long>"), "signatures")
    nodes = cut(signed.groupBy("node").agg(F.min("row").alias("least"), F.first("prints").alias("prints"), F.count("*").alias("count")), "nodes")
    members = cut(clusters(nodes.select("node", "prints"), bucket), "members")
    wanted = cut(nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("least").alias("wanted"), "prints"), "wanted")
    side = wanted.select("wanted")
    side = F.broadcast(side) if wanted.count() <= broadcast_ids else side
    sets = cut(rows.join(side, F.col("row") == F.col("wanted"), "left_semi").select("text").mapInArrow(lambda b: set_batches(b, shingle), "node long, found array<long>"), "sets")
    if not sets.groupBy("node").count().filter("count > 1").isEmpty():  # equal rows
        sets = cut(sets.dropDuplicates(["node"]), "sets")
    roots = components(links(members, wanted.select("node", "prints"), sets, percent, min(block, BLOCK)), "a", "b").withColumnRenamed("node", "linked")
    named = cut(nodes.join(roots, F.col("node") == F.col("linked"), "left").select(F.col("node").alias("of"), F.coalesce("root", "node").alias("root"), "least", F.col("count").alias("rows")), "named")
    least = cut(named.groupBy("root").agg(F.min("least").alias("first"), F.count("*").alias("count")), "least")
    named = cut(look_up(named, least, "root", nodes.count()).select(F.col("of").alias("node"), "first", F.col("rows").alias("count")), "firsts")
    return look_up(signed.select("row", "node"), named, "node", signed.count()).select("row", "first")


def near_copies(docs: DataFrame, **options) -> DataFrame:
    """doc_id and component_id (the least doc_id of its class) of each row."""
    return classes(docs, **options).select(F.col("row.id").alias("doc_id"), F.col("first.id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_ids: int = 1_000_000, **options) -> DataFrame:
    """The least row of each class (the one with the least id), with its own columns; of equal ones one stays.

    Texts aren't shuffled: the rows that go are joined by id and hash of the text, broadcast if there are
    at most broadcast_ids of them. Only rows that are there twice are compared as a whole.
    """
    found = cut(classes(docs, id_col=id_col, text_col=text_col, broadcast_ids=broadcast_ids, **options), "classes")
    gone = cut(found.filter("row <> first").select(F.col("row").alias("other")).distinct(), "gone")
    twice = cut(found.filter("row = first").groupBy("row").count().filter("count > 1").select(F.col("row").alias("other")), "twice")

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= broadcast_ids else df

    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("own"), _key(docs, id_col, text_col))
    same = F.col("row") == F.col("other")
    kept = keyed.join(side(gone), same, "left_anti")
    if not twice.isEmpty():
        again = side(twice)
        kept = kept.join(again, same, "left_anti").union(kept.join(again, same, "left_semi").dropDuplicates(["row"]))
    return kept.select("own.*")
