"""SimHash near-dedup with a generalised pigeonhole over correlated bits.

Fingerprints are taken per document in one narrow pass. Equal fingerprints are one node. To link nodes at `distance` or fewer differing bits:

1. counts of bits and bit pairs over all nodes give the correlations; correlated bits are put into
   the same of m partitions, m being the cheapest by the estimated candidates;
2. partition i gets a threshold t_i >= -1 (-1: unused) with sum(t_i) = distance - m + 1, so every
   pair within the distance agrees up to t_i bits in some partition i. Dynamic programming picks the
   thresholds on the candidates of each partition: colliding pairs counted over all nodes, carried to
   larger thresholds by the bits' difference rates, plus the rows that probing costs;
3. every node is indexed by the keys up to ceil(t_i / 2) flips away from its bits in a partition, and
   probes those up to floor(t_i / 2) flips away, so two nodes that differ in t_i bits meet;
4. buckets are sorted streams, so a task holds one bucket at a time. Its nodes are compared and a
   spanning forest of its links is kept, so a group of k near copies costs k links and not k * k. A
   bucket of more than `block` rows is dealt into blocks, and every pair of blocks is compared in its
   own group, so no task holds a whole hot bucket.

Components of the links give the classes; a class is named by the smallest id of its rows.

Edge cases: null or blank text has fingerprint 0 and is linked like any other; so is a row without an id, and
a class is null only if no row of it has an id; repeated rows and ids stay, and an id with several texts has a
row, and perhaps a class, for each (an id by itself links nothing); ties of fingerprints are one node; very long texts are hashed 65,536 shingles at a time;
an empty table gives an empty table; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, look_up, ship
from millrace.llm.components import components

BITS = 64
SEED = 42
#: Shingles hashed at a time, which bounds memory for very long texts.
_STEP = 1 << 16


def shingle_hashes(text: str | None, size: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles in order, _STEP at a time; nothing without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(size, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    for i in range(0, len(starts), _STEP):
        cuts = map(slice, starts[i : i + _STEP].tolist(), ends[i : i + _STEP].tolist())
        yield np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64)


def majority(parts: Iterator[np.ndarray]) -> int:
    """Bit i is set if it is set in over half of the hashes; 0 without any."""
    counts, n = np.zeros(BITS, np.int64), 0
    for h in parts:
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0]) if n else 0


def fingerprint(text: str | None, shingle: int = 4) -> int:
    return majority(shingle_hashes(text, shingle))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_signed(fingerprint(v.as_py(), shingle)) for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])


def bit_pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        for i in range(0, len(fp), 8192):
            x = np.unpackbits(np.ascontiguousarray(fp[i : i + 8192]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += (x.T @ x).astype(np.int64)
    i, j = np.triu_indices(BITS)
    yield pa.RecordBatch.from_arrays([pa.array(i * BITS + j, pa.int64()), pa.array(total[i, j], pa.int64())], ["pair", "n"])


def bit_statistics(nodes: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rate of each bit, and the absolute correlation of each pair of bits, over all nodes."""
    rows = nodes.select("fp").mapInArrow(bit_pair_batches, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    joint = np.zeros((BITS, BITS))
    for r in rows:  # 2080 numbers
        joint[r.pair // BITS, r.pair % BITS] = joint[r.pair % BITS, r.pair // BITS] = r.n / n
    p = joint.diagonal().copy()
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return p, np.abs((joint - np.outer(p, p)) / np.outer(spread, spread))


def group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """m groups of near-equal width: each starts at the strongest free pair and takes the closest bits."""
    free, groups = set(range(BITS)), []
    for g in range(m):
        width = BITS // m + (g < BITS % m)
        rest = sorted(free)
        sub = np.triu(corr[np.ix_(rest, rest)], 1)
        a, b = np.unravel_index(int(sub.argmax()), sub.shape)
        group = [rest[a], rest[b]]
        while len(group) < width:
            left = sorted(free - set(group))
            group.append(left[int(corr[np.ix_(left, group)].mean(1).argmax())])
        groups.append(sorted(group))
        free -= set(group)
    return groups


def difference_chances(p: np.ndarray, group: list[int], most: int) -> np.ndarray:
    """Chance that two rows differ in at most t bits of the group, t = 0..most."""
    chance = np.zeros(most + 2)
    chance[0] = 1
    for q in (2 * p[group] * (1 - p[group])).tolist():
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
        chance[-1] = 0
    return np.cumsum(chance[: most + 1])


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with the given sum at the least cost; costs[i][t + 1] is that of t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for k, x in enumerate(row):
                if (v := s + k - 1) not in new or new[v][0] > c + x:
                    new[v] = (c + x, [*ts, k - 1])
        best = new
    return best[total]


def flips(group: list[int], t: int) -> list[int]:
    """Masks with 1 to t bits of the group."""
    return [_signed(sum(1 << b for b in c)) for r in range(1, t + 1) for c in combinations(group, r)]


#: Cost of comparing a pair, against that of one more row to shuffle; and the largest threshold.
_PAIR_COST, _MOST = 0.05, 4


def _costs(n: float, groups: list[list[int]], p: np.ndarray, pairs: list[float] | None, distance: int) -> list[list[float]]:
    out = []
    for i, g in enumerate(groups):
        chance = difference_chances(p, g, distance)
        base = pairs[i] if pairs else n * n / 2 * chance[0]
        row = [0.0]
        for t in range(min(distance, _MOST) + 1):
            found = base * chance[t] / max(chance[0], 1e-300)
            row.append(n * (1 + sum(comb(len(g), r) for r in range(1, (t + 1) // 2 + 1))) + _PAIR_COST * found)
        out.append(row)
    return out


def plan_partitions(nodes: DataFrame, n: int, distance: int, planned: int = 0) -> list[tuple[list[int], int]]:
    """The groups of bits with their thresholds; unused ones are left out. With `planned`, those that are the best for
    at least so many nodes, so that smaller tables are searched alike."""
    more = max(n, planned) / n
    p, corr = bit_statistics(nodes, n)
    ways = {}
    for m in range(2, distance + 2):
        if distance - m + 1 <= _MOST * m:
            groups = group_bits(corr, m)
            ways[allocate(_costs(n * more, groups, p, None, distance), distance - m + 1)[0]] = groups
    groups = ways[min(ways)]
    keys = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in g)))).alias("key")) for i, g in enumerate(groups)])
    sizes = nodes.select(F.explode(keys).alias("x")).groupBy("x.part", "x.key").count().filter("count > 1")
    counted = dict(sizes.groupBy("part").agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).collect())
    pairs = [float(counted.get(i, 0)) * more**2 for i in range(len(groups))]
    _, thresholds = allocate(_costs(n * more, groups, p, pairs, distance), distance - len(groups) + 1)
    return [(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, or of rows of fingerprints."""
    bits = np.bitwise_count(x ^ y)
    return bits.sum(-1, dtype=np.int64) if bits.ndim > 1 else bits


def bucket_links(fp: np.ndarray, distance: int) -> list[tuple[int, int, int]]:
    """Pairs of positions that span the links among the fingerprints of a bucket, each with the first
    position of its class."""
    out: list[tuple[int, int, int]] = []
    left = np.arange(len(fp))
    while len(left):
        first = int(left[0])
        todo, left = [first], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = apart(fp[left], fp[x]) <= distance
            if near.any():
                hits = left[near].tolist()
                left = left[~near]
                out += zip(repeat(x), hits, repeat(first))
                todo += hits
    return out


#: Buckets of up to so many nodes are compared many at a time.
_SMALL = 8


def stream_links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, class) of spanning links, from rows (part, key, pair, fp, node) in bucket order.

    fp is a fingerprint or an array of them, whose bits count together."""

    def column(c: pa.Array) -> np.ndarray:
        return c.flatten().to_numpy().reshape(len(c), -1) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False)

    rest: list[np.ndarray] | None = None
    for batch in chain(batches, [None]):
        if batch is not None:
            now = [column(c) for c in batch.columns]
            now = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
        elif rest is None:
            return
        else:
            now = rest
        part, key, pair, fp, node = now
        new = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])) + 1
        last = len(part) if batch is None else int(new[-1]) if len(new) else 0
        rest = [x[last:] for x in now]
        if not last:
            continue
        starts = np.concatenate(([0], new[new < last]))
        sizes = np.diff(np.append(starts, last))
        bucket = np.repeat(np.arange(len(starts)), sizes)
        bits = fp.view(np.uint64)
        small = np.repeat(sizes <= _SMALL, sizes)
        a, b, of = [], [], []
        for d in range(1, min(_SMALL, int(sizes.max()))):
            at = np.flatnonzero((bucket[d:] == bucket[:-d]) & small[d:])
            at = at[apart(bits[at], bits[at + d]) <= distance]
            a.append(node[at]), b.append(node[at + d]), of.append(bucket[at] * last + at)
        for k in np.flatnonzero(sizes > _SMALL).tolist():
            s = int(starts[k])
            if found := bucket_links(bits[s : s + int(sizes[k])], distance):
                x, y, first = np.array(found).T + s
                a.append(node[x]), b.append(node[y]), of.append(k * last + first)
        if sum(map(len, a)):
            yield np.concatenate(a), np.concatenate(b), np.concatenate(of)


def link_batches(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for a, b, _ in stream_links(batches, distance):
        differ = a != b
        yield pa.RecordBatch.from_arrays([pa.array(a[differ], pa.int64()), pa.array(b[differ], pa.int64())], ["a", "b"])


def _entries(part: int, fp: Column, group: list[int], t: int) -> Column:
    """The keys in a partition up to ceil(t / 2) flips away from a fingerprint's own."""
    key = fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in group))))
    masks = F.array(F.lit(0).cast("long"), *[F.lit(m).cast("long") for m in flips(group, (t + 1) // 2)])
    return F.transform(masks, lambda m: F.struct(F.lit(part).alias("part"), key.bitwiseXOR(m).alias("key"), fp.alias("fp")))


def buckets(nodes: DataFrame, distance: int, block: int, words: int = 1, broadcast_keys: int = 10_000, planned: int = 0) -> DataFrame | None:
    """part, key, pair, fp and node, sorted within partitions so that each bucket is a run of rows.

    nodes: node and fp, or `fps`, an array of `words` independent fingerprints that are all searched with the
    partitions of the first (they are alike in distribution). None if there are fewer than two nodes.
    """
    n = nodes.count()
    if n < 2:
        return None
    fps = [F.col("fps")[k] for k in range(words)] if words > 1 else [F.col("fp")]
    plan = plan_partitions(nodes.select(fps[0].alias("fp")), n, distance, planned)
    entries = [_entries(k * len(plan) + i, fp, group, t) for k, fp in enumerate(fps) for i, (group, t) in enumerate(plan)]
    rows = nodes.select("node", F.explode(F.concat(*entries)).alias("x")).select("node", "x.*")
    return dealt(rows, block, n * sum(1 + len(flips(group, (t + 1) // 2)) for group, t in plan) * words, broadcast_keys)


#: Cells of a first count that are broadcast; the mean load of a cell is a block over LOAD.
CELLS, LOAD = 1_000_000, 4


def hot_buckets(rows: DataFrame, block: int, n: int) -> DataFrame:
    """hot_part, hot_key and n of the buckets with more than `block` rows. n: number of rows.

    Most buckets hold a row or two, so counting each would shuffle as many rows as there are. So cells of many buckets
    are counted first, which tasks sum before the shuffle; only the buckets of a cell that is over the block are counted.
    """
    cell = F.pmod(F.xxhash64("part", "key"), F.lit(LOAD * n // block + 1))
    full = cut(rows.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).filter(F.col("n") > block).select("cell"), "full-cells")
    n_full = full.count()
    inside = rows if n_full > CELLS else rows.join(F.broadcast(full), cell == F.col("cell"), "left_semi")
    counted = inside.groupBy(F.col("part").alias("hot_part"), F.col("key").alias("hot_key")).agg(F.count("*").alias("n")).filter(F.col("n") > block)
    return cut(counted if n_full else counted.limit(0), "hot-buckets")


def dealt(rows: DataFrame, block: int, n: int, broadcast_keys: int = 10_000) -> DataFrame:
    """Rows of part, key, fp and node with `pair`, in bucket order; a bucket of over `block` rows is dealt into
    blocks, and each pair of blocks is a bucket of its own. n: number of rows.

    Of more than broadcast_keys hot buckets those with over 1 in broadcast_keys rows are broadcast, the others joined.
    """
    hot = hot_buckets(rows, block, n)
    n_hot = hot.count()
    rows = rows.withColumn("pair", F.lit(0).cast("long"))
    if n_hot:
        same = (F.col("part") == F.col("hot_part")) & (F.col("key") == F.col("hot_key"))
        often = F.lit(True) if n_hot <= broadcast_keys else F.col("n") * broadcast_keys > n
        first, others = (hot.filter(x).select("hot_part", "hot_key", F.ceil(F.col("n") / block).alias("blocks")) for x in (often, ~often))
        met = rows.join(F.broadcast(first), same, "left")
        if n_hot > broadcast_keys:
            rest = met.filter("blocks is null").select(*rows.columns).join(others, same, "left")
            met = met.filter("blocks is not null").select(*rows.columns, "blocks").unionByName(rest.select(*rows.columns, "blocks"))
        rows = met
        own = F.pmod(F.xxhash64("fp", "node"), F.col("blocks"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        rows = rows.withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
        rows = rows.select("part", "key", "fp", "node", "blocks", own.alias("mine"), other.alias("other"))
        rows = rows.withColumn("pair", F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other"))
    # the key comes first in the order, since it tells most rows apart
    return rows.select("part", "key", "pair", "fp", "node").repartition("part", "key", "pair").sortWithinPartitions("key", "part", "pair")


def links(nodes: DataFrame, distance: int, block: int = 2048) -> DataFrame:
    """A spanning set of the pairs (a, b) of nodes at `distance` or fewer differing bits."""
    rows = buckets(nodes, distance, block)
    if rows is None:
        return nodes.sparkSession.createDataFrame([], "a long, b long")
    return rows.mapInArrow(lambda b: link_batches(b, distance), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", block: int = 2048) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    prints = cut(rows.mapInArrow(lambda b: fingerprint_batches(b, shingle), "doc_id long, fp long"), "fingerprints")
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("count")), "nodes")
    found = cut(components(links(nodes.select("fp", F.col("fp").alias("node")), distance, block), "a", "b"), "roots")
    rooted = cut(nodes.join(found, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("of_fp"), F.coalesce("root", "fp").alias("root"), "least", F.col("count").alias("rows")), "rooted")
    classes = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("count")), "classes")
    named = cut(look_up(rooted, classes, "root", nodes.count()).select("of_fp", "component_id", F.col("rows").alias("count")), "named")
    out = look_up(prints, named.withColumnRenamed("of_fp", "fp"), "fp", prints.count())
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
