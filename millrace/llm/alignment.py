"""Alignment of two tokenizers over byte intervals.

A token of either tokenizer is the interval of bytes that it stands for. The intervals of B are a static
index, its sorted ends; each token of A stabs it by bisection and gets the run of B tokens that it
overlaps: the links. An end of an A token that no B token spans is a place where both end: it closes a
group.

Both tokenizers end a token before a space that follows a character that isn't white space (A's rule of
words takes a space only first, B's marks stand only first in a piece). So a text is cut there, each
distinct chunk is aligned once by a worker, and a text's groups and links are those of its chunks in order.

Texts are encoded in one narrow pass, which writes the figures and the distinct linked pairs of each. How many
documents hold an id pair linked is counted from these pairs: tasks count many texts and hand on sums. A narrow
pass over the pairs looks the counts up, without the tokenizers. Pairs in more than 1 of SHARE of all
(document, pair) incidences are broadcast, fewer than SHARE by arithmetic; the rare ones of a document
meet their counts in a shuffle, where no pair is frequent.

Edge cases: null and empty texts, and texts whose bytes the tokens of A or B don't give back (such as those with
U+2581), have no tokens and count for no pair; special strings inside texts are plain text; repeated rows
are documents of their own; a null id keeps its row; ties of the highest count are all best; very long texts
are read whole; an empty table gives an empty table; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, ship
from millrace.llm.pieces import MARK, Model, model, runs

#: Pairs with over 1 of so many incidences are broadcast.
SHARE = 2_000_000
#: Chunks that a worker remembers and the bytes they may have; pairs that a task counts before it hands them on.
REMEMBERED, REMEMBERED_BYTES, _COUNTED = 500_000, 1 << 27, 2_000_000
#: Chunks that are encoded as one text.
_TOGETHER = 50
#: A space, and all up to the next space that follows a character that isn't white space.
_CHUNK = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")
_SPACES = re.compile(r"\s ")
_loaded: dict[tuple[str, str], "Aligner"] = {}


def stab(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each A token the first and last B token that it overlaps, and whether a B token ends with it."""
    last = np.searchsorted(b_ends, a_ends)
    first = np.searchsorted(b_ends, np.concatenate(([0], a_ends[:-1])), "right")
    return first, last, b_ends[last] == a_ends


class Grown:
    """An array to which rows are added at the end."""

    def __init__(self, *width: int) -> None:
        self.data, self.n = np.zeros((1024, *width), np.int64), 0

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros((self.n + 2 * len(rows), *self.data.shape[1:]), np.int64)])
        self.data[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


class Chunks:
    """What is known of the chunks met so far, by number: figures (n_a, n_b, n_groups, n_links, whether its bytes don't
    come back, and the place behind its last pair), groups as text, and the codes of all linked pairs in a row."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.figures, self.pairs = Grown(6), Grown()
        self.bytes = 0


class Aligner:
    """Two vocabulary files: A for the tokenizers library (byte level), B for sentencepiece."""

    def __init__(self, a_path: str, b_path: str) -> None:
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b: Model = model(b_path)
        spec = json.loads(self.a.to_str())
        first = spec["pre_tokenizer"] or {}
        self.splits = self.b.splits and not spec["normalizer"] and first.get("type") == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]
        # of the characters that stand for bytes, those that print stand for themselves, the others follow from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(c): c for c in own} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in own)}
        self.label = {i: bytes(map(byte.__getitem__, t)) if set(t) <= byte.keys() else t.encode() for t, i in self.a.get_vocab().items()}
        self.a_sizes = np.array([len(self.label.get(i, b"")) for i in range(max(self.label) + 1)])
        self.b_sizes = np.array([*map(len, self.b.labels)])
        # ids of A as words with a comma or a bar behind them, and of B with a comma or a semicolon
        self.b_from = 3 * len(self.a_sizes)
        self.words = [f"{i}{sign}" for i in range(max(len(self.a_sizes), len(self.b_sizes))) for sign in ",|;"]
        self.words = self.words[: self.b_from] + self.words[: 3 * len(self.b_sizes)]
        self.chunks = Chunks()

    def cut(self, text: str) -> list[str]:
        """The chunks of a space and the text, each without its first space; none of an empty text."""
        if not text:
            return []
        if not self.splits:
            return [text]
        return [c[1:] for c in _CHUNK.findall(" " + text)] if text[0] == " " or _SPACES.search(text) else text.split(" ")

    def same(self, chunks: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Of which chunks both tokenizers give back the bytes."""
        label, piece = self.label.__getitem__, self.b.labels.__getitem__
        return np.array([b"".join(map(label, x)) == f" {c}".encode() == b"".join(map(piece, y)) for c, x, y in zip(chunks, a, b, strict=True)], bool)

    def learn(self, new: list[str]) -> None:
        """Align chunks and enter them. Chunks are encoded many in a text, since texts are cut where both tokenizers end
        a token; those that such a cut can't follow (white space at the end) or that hold a mark are encoded one by one."""
        odd = [c for c in new if not self.splits or not c or c[-1].isspace() or MARK in c]
        alone = set(odd)
        plain = [c for c in new if c not in alone] if odd else new
        if plain:
            texts = [" ".join(plain[i : i + _TOGETHER]) for i in range(0, len(plain), _TOGETHER)]
            a = [*chain.from_iterable(e.ids for e in self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False))]
            b = [*chain.from_iterable(self.b.library.encode(texts, num_threads=1))]
            whole = "".join([f" {t}" for t in texts]).encode()
            if b"".join(map(self.label.__getitem__, a)) == whole == b"".join(map(self.b.labels.__getitem__, b)):
                ends = np.cumsum(np.fromiter(map(len, map(str.encode, plain)), np.int64, len(plain)) + 1)
                a_ids, b_ids = np.array(a, np.int64), np.array(b, np.int64)
                n_a, n_b = (np.diff(np.searchsorted(np.cumsum(size[ids]), ends, "right"), prepend=0) for size, ids in ((self.a_sizes, a_ids), (self.b_sizes, b_ids)))
                self.enter(plain, a_ids, b_ids, n_a, n_b, np.ones(len(plain), bool))
            else:
                odd = new
        if odd:
            a = [e.ids for e in self.a.encode_batch_fast([f" {c}" for c in odd], add_special_tokens=False)]
            b = self.b.segment(odd)
            good = self.same(odd, a, b)
            a, b = ([x if g else [] for x, g in zip(side, good.tolist(), strict=True)] for side in (a, b))
            n_a, n_b = (np.fromiter(map(len, side), np.int64, len(odd)) for side in (a, b))
            a_ids, b_ids = (np.fromiter(chain.from_iterable(side), np.int64) for side in (a, b))
            self.enter(odd, a_ids, b_ids, n_a, n_b, good)

    def enter(self, new: list[str], a_ids: np.ndarray, b_ids: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, good: np.ndarray) -> None:
        """Align chunks that lie end to end, so that one index answers for all of them."""
        known = self.chunks
        first, last, ends = stab(np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids]))
        width = last - first + 1
        of_a = np.repeat(np.arange(len(a_ids)), width)
        codes = a_ids[of_a] << 32 | b_ids[np.repeat(first - np.cumsum(width) + width, width) + np.arange(len(of_a))]
        chunk = np.repeat(np.arange(len(new)), n_a)
        links = np.bincount(chunk, width, len(new)).astype(np.int64)
        groups = np.bincount(chunk, ends, len(new)).astype(np.int64)
        known.numbers.update(zip(new, range(known.figures.n, known.figures.n + len(new)), strict=True))
        known.bytes += sum(map(len, new)) + 8 * len(codes)
        found = self.group_texts(a_ids, b_ids, ends, last[ends], n_a + n_b)
        known.groups += found
        known.bytes += sum(map(len, found))
        known.figures.add(np.stack([n_a, n_b, groups, links, ~good, known.pairs.n + np.cumsum(links)], 1))
        known.pairs.add(codes)

    def group_texts(self, a_ids: np.ndarray, b_ids: np.ndarray, a_ends: np.ndarray, b_last: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The groups of each chunk as text: tokens by group, those of A first, each with the sign behind it."""
        b_ends = np.zeros(len(b_ids), bool)
        b_ends[b_last] = True
        place = np.concatenate([2 * (np.cumsum(a_ends) - a_ends), 2 * (np.cumsum(b_ends) - b_ends) + 1])
        signed = np.concatenate([a_ids * 3 + a_ends, self.b_from + b_ids * 3 + 2 * b_ends])[np.argsort(place, kind="stable")]
        words, upto = [*map(self.words.__getitem__, signed.tolist())], np.cumsum(sizes).tolist()
        return ["".join(words[i:j])[:-1].encode() for i, j in zip([0, *upto], upto, strict=False)]

    def numbered(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's chunks in order; an empty array for a text without tokens."""
        if self.chunks.figures.n > REMEMBERED or self.chunks.bytes > REMEMBERED_BYTES:
            self.chunks = Chunks()
        known, every = self.chunks, [self.cut(t) for t in texts]
        new = [c for c in set().union(*every) if c not in known.numbers]
        if new:
            self.learn(new)
        numbers, bad = known.numbers.__getitem__, known.figures.data[:, 4]
        out = [np.fromiter(map(numbers, chunks), np.int64, len(chunks)) for chunks in every]
        return [n[:0] if bad[n].any() else n for n in out]

    def linked(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of the id pairs linked in some chunks, in order of the chunks, and the chunk of each."""
        sizes = self.chunks.figures.data[numbers, 3]
        first = self.chunks.figures.data[numbers, 5] - sizes
        of = np.repeat(np.arange(len(numbers)), sizes)
        return self.chunks.pairs.data[(first - np.cumsum(sizes) + sizes)[of] + np.arange(len(of))], of


def aligner(a_path: str, b_path: str) -> Aligner:
    key = (a_path, b_path)
    return _loaded.get(key) or _loaded.setdefault(key, Aligner(*key))


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Values as arrays of the given sizes."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.int64()))


def link_batches(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """The figures of each text, its distinct linked pairs and how often it has each."""
    both = aligner(a_path, b_path)
    for batch in batches:
        done = 0
        for run in runs(batch.column(1)):
            numbers = both.numbered(run)
            sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
            every = np.concatenate(numbers)
            upto = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(both.chunks.figures.data[every, :4], 0)])
            ends = np.cumsum(sizes)
            figures = upto[ends] - upto[ends - sizes]
            codes, places = both.linked(every)[0], np.cumsum(figures[:, 3])
            found = [np.unique(codes[j - n : j], return_counts=True) for n, j in zip(figures[:, 3].tolist(), places.tolist(), strict=True)]
            distinct = np.fromiter((len(p) for p, _ in found), np.int64, len(found))
            groups = both.chunks.groups
            digests = [hashlib.sha256(b";".join([groups[k] for k in n.tolist()])).hexdigest() if len(n) else "" for n in numbers]
            pairs, times = (lists(np.concatenate(side), distinct) for side in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(run)), *(pa.array(c, pa.int64()) for c in figures.T), pa.array(digests, pa.string()), pairs, times], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
            done += len(run)


def pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair and the number of texts that hold it linked, in sums over many texts."""
    held, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def merged() -> None:
        pairs, at = np.unique(np.concatenate(held), return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, at, np.concatenate(counts))
        held[:], counts[:] = [pairs], [sums]

    def handed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held[0], pa.int64()), pa.array(counts[0], pa.int64())], ["pair", "n"])

    for batch in batches:
        pairs, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
        held.append(pairs), counts.append(n)
        if sum(map(len, held)) > 2 * _COUNTED:
            merged()
            if len(held[0]) > _COUNTED:
                yield handed()
                held[:], counts[:] = [held[0][:0]], [counts[0][:0]]
    merged()
    yield handed()


def sum_batches(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """n_best and count_sum of the pairs that are broadcast, and the other pairs."""
    pairs, counts, best = sent.value
    for batch in batches:
        *columns, held, times = batch.columns
        codes, often = held.flatten().to_numpy(), times.flatten().to_numpy()
        of = np.repeat(np.arange(len(held)), held.value_lengths().to_numpy())
        at = np.minimum(np.searchsorted(pairs, codes), max(len(pairs) - 1, 0))
        known = pairs[at] == codes if len(pairs) else np.zeros(len(codes), bool)
        sums, bests = (np.bincount(of[known], value[at[known]] * often[known], len(held)).astype(np.int64) for value in (counts, best))
        rare = np.bincount(of[~known], minlength=len(held))
        yield pa.RecordBatch.from_arrays([*columns, pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), lists(codes[~known], rare), lists(often[~known], rare)], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "rare", "times"])


_FIGURES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def linked(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct linked pairs (a << 32 | b) with their times, of each row."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(lambda b: link_batches(b, a_path, b_path), f"{_FIGURES}, pairs array<long>, times array<long>")


def counted(rows: DataFrame) -> DataFrame:
    """pair, a, b, n (documents that hold the ids linked) and best: whether no other B id of this A id has more. rows: pairs."""
    found = rows.select("pairs").mapInArrow(pair_batches, "pair long, n long")
    sums = cut(found.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    # one row an A id, so the size of A's vocabulary at most
    most = sums.groupBy(F.shiftright("pair", 32).alias("of")).agg(F.max("n").alias("most"))
    a = F.shiftright("pair", 32)
    return sums.join(F.broadcast(most), a == F.col("of")).select("pair", a.cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"), "n", (F.col("n") == F.col("most")).alias("best"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """pair, a, b, n and best of `counted`, from texts."""
    return counted(linked(docs, a_path, b_path, text_col, text_col))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row."""
    spark = docs.sparkSession
    rows = cut(linked(docs, a_path, b_path, id_col, text_col), "linked")
    counts = cut(counted(rows), "pairs")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = counts.filter(F.col("n") * share > total).select("pair", "n", "best").toPandas().sort_values("pair")  # fewer than share rows
    sent = spark.sparkContext.broadcast((often.pair.to_numpy(np.int64), often.n.to_numpy(np.int64), often.best.to_numpy(np.int64)))
    found = cut(rows.mapInArrow(lambda b: sum_batches(b, sent), f"{_FIGURES}, n_best long, count_sum long, rare array<long>, times array<long>").withColumn("row", F.monotonically_increasing_id()), "aligned")
    met = found.filter(F.size("rare") > 0)
    asked = met.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("code"), "x.times")
    answers = asked.join(counts.filter(F.col("n") * share <= total), F.col("code") == F.col("pair"))
    sums = answers.groupBy("row").agg(F.sum(F.col("n") * F.col("times")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")).withColumnRenamed("row", "of")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    late = met.join(sums, F.col("row") == F.col("of")).select(*names, (F.col("n_best") + F.col("more_best")).alias("n_best"), (F.col("count_sum") + F.col("more")).alias("count_sum"), "groups_sha256")
    return found.filter(F.size("rare") == 0).select(*names, "n_best", "count_sum", "groups_sha256").union(late)


def token_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the groups of each text: arrays of A ids and of B ids, in order."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in found:
            texts = [b";".join([both.chunks.groups[k] for k in n.tolist()]).decode() for run in runs(batch.column(1)) for n in both.numbered(run)]
            groups = [[dict(zip("ab", ([int(i) for i in side.split(",")] for side in g.split("|")), strict=True)) for g in t.split(";")] if t else [] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(groups, pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))], ["doc_id", "groups"])

    return rows.mapInArrow(batches, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")
