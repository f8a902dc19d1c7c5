"""Spelling variants by a positional q-gram inverted index with a count filter.

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z in lower case. Two words are near
if one inserted, deleted or replaced code point turns one into the other; a word's form is its most
frequent near word if that is `ratio` times as frequent or more, and its root is the last form reached.

1. Tasks count the words of whole texts; only distinct words and their counts are shuffled.
2. Words are dealt out by length and by an anchor: the first three or the last three letters. One edit
   leaves one of both as it is, since a word has six letters or more. A word of l letters is indexed and
   asked in the groups of length l, and asked in those of length l - 1 (the length limit).
3. In a group every word asks an index of (2-gram, place) -> words. The postings of its grams, at the same
   place for equal lengths and there or one before for a word with one letter more (the position limit),
   are sorted lists; a word that is in max(lengths) - 3 or more of them shares as many grams as one edit
   leaves. The two grams of the anchor are common to the whole group, so they are taken off the bound. A heap
   merges the shortest lists, of which no word can miss all and keep the bound, the longer ones are searched
   for what comes out, and what keeps the bound is verified letter by letter.
4. A group of more than `block` words is dealt into blocks, and each pair of blocks is a group of its own.
5. Counts and best near words are partial aggregates by word; roots come from doubling the chains of forms.

Edge cases: null and blank texts have no words; a null id counts as an empty one; repeated rows count
again; ties of the best near word go to the one that is first in code-point order; very long texts and
words are read whole; no words give an empty table; other columns of the input are ignored, whatever
their names.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, drop_table, ship

#: Letters of a gram and of an anchor; the least letters of a word that both anchors and the bound need.
GRAM, ANCHOR, LEAST = 2, 3, 6
#: Distinct words that a task counts, and bytes of text that it reads, before it hands its counts on.
_HELD, _READ = 200_000, 1 << 26
#: Of a Latin-1 byte: the lower-case letter, or a space.
_LETTERS = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; letters fit one byte each until they are split."""
    letters = (text or "").encode("latin-1", "replace").translate(_LETTERS)
    return (letters if letters.isascii() else letters.decode("latin-1").encode()).split()


def damaged(words: list[bytes], doc_id: int | None, one_in: int) -> list[bytes]:
    """The words, of which every one whose checksum with the id is a multiple of one_in has lost a letter."""
    sums = np.fromiter(map(crc32, words, repeat(crc32(f"{'' if doc_id is None else doc_id}:".encode()))), np.uint32, len(words))
    for k in np.flatnonzero(sums % one_in == 0).tolist():
        word = words[k].decode()
        at = int(sums[k]) % len(word)
        words[k] = (word[:at] + word[at + 1 :]).encode()
    return words


def count_batches(batches: Iterator[pa.RecordBatch], least: int, one_in: int | None) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()
    room = _READ

    def handed() -> pa.RecordBatch:
        long = [w for w in counts if len(w) >= least and (w.isascii() or len(w.decode()) >= least)]
        return pa.RecordBatch.from_arrays([pa.array(long, pa.binary()).cast(pa.string()), pa.array(map(counts.__getitem__, long), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = words_of(text.as_py())
            counts.update(damaged(words, doc_id, one_in) if one_in else words)
            room -= sum(map(len, words))
            if len(counts) > _HELD or room < 0:
                yield handed()
                counts.clear()
                room = _READ
    if counts:
        yield handed()


def word_counts(docs: DataFrame, least: int, least_n: int, one_in: int | None, id_col: str, text_col: str) -> DataFrame:
    """word and n of the words with at least `least` letters and least_n occurrences."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    found = rows.mapInArrow(lambda b: count_batches(b, least, one_in), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


def one_edit(a: str, b: str) -> bool:
    """Whether one edit turns a into b; a isn't longer than b, and they differ."""
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


class Index:
    """Postings of (gram, place) for words of one length: their numbers, in rising order."""

    def __init__(self) -> None:
        self.postings: dict[tuple[str, int], list[int]] = {}

    def add(self, number: int, word: str, places: range) -> None:
        for p in places:
            self.postings.setdefault((word[p : p + GRAM], p), []).append(number)

    def share(self, word: str, places: range, shift: int, bound: int) -> Iterator[int]:
        """Numbers that share the grams of `bound` or more of the places, each found there or up to `shift` before.

        Such a number is in the postings of at least one of any len(places) - bound + 1 places. So only those with
        the fewest postings are merged, and the others are searched for what comes out.
        """
        find = self.postings.get
        every = [[x for s in range(shift + 1) if (x := find((word[p : p + GRAM], p - s)))] for p in places]
        every.sort(key=lambda lists: sum(map(len, lists)))
        merged, others = every[: len(every) - bound + 1], every[len(every) - bound + 1 :]
        for number, times in groupby(heapq.merge(*chain.from_iterable(merged))):
            count, left = sum(1 for _ in times), len(others)
            for lists in others:
                if count >= bound or count + left < bound:
                    break
                left -= 1
                count += any(x[at] == number for x in lists if (at := bisect_left(x, number)) < len(x))
            if count >= bound:
                yield number


def group_pairs(side: int, size: int, crossed: bool, words: list[str], blocks: list[int]) -> Iterator[tuple[int, int]]:
    """Near words (a, b) of a group, by position. Words are in order of their lengths and have `size` letters or one more and share their first
    (side 0) or last letters; in a crossed group only pairs of different blocks count. Pairs that share both
    ends belong to side 0."""
    index = {b: Index() for b in set(blocks)}
    other = {b: index[c] for b in index for c in index if (b != c) == crossed}
    none = Index()
    for k, word in enumerate(words):
        longer = len(word) - size
        places = range(GRAM, len(word) - 1) if side == 0 else range(len(word) - 1 - GRAM)
        for near in other.get(blocks[k], none).share(word, places, longer, len(word) - 1 - 2 * GRAM):
            if (side == 0 or words[near][:ANCHOR] != word[:ANCHOR]) and one_edit(words[near], word):
                yield near, k
        if not longer:
            index[blocks[k]].add(k, word, places)


def near_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n, near and near_n, both ways, of the pairs in each run of equal (side, anchor, size, pair, crossed)."""
    rows = chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)
    out: list[tuple] = []

    def handed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["word", "n", "near", "near_n"])

    for (side, _, size, _, crossed), run in groupby(rows, key=lambda r: r[:5]):
        *_, blocks, words, counts = map(list, zip(*sorted(run, key=lambda r: (len(r[6]), r[6])), strict=True))
        if len(words[0]) > size:  # nothing to ask
            continue
        for a, b in group_pairs(side, size, crossed, words, blocks):
            out += (words[a], counts[a], words[b], counts[b]), (words[b], counts[b], words[a], counts[a])
            if len(out) > 20_000:
                yield handed()
                out.clear()
    if out:
        yield handed()


def near_words(words: DataFrame, block: int = 4_000, broadcast_keys: int = 10_000) -> DataFrame:
    """word, n, near and near_n of all pairs of near words, both ways. words: word and n, each word once."""
    size = F.char_length("word")
    ends = F.array(F.struct(F.lit(0).alias("side"), F.left("word", F.lit(ANCHOR)).alias("anchor")), F.struct(F.lit(1).alias("side"), F.right("word", F.lit(ANCHOR)).alias("anchor")))
    rows = words.select("word", "n", F.explode(ends).alias("x")).select("word", "n", "x.*", F.explode(F.array(size, size - 1)).alias("size"))
    key = ["side", "anchor", "size"]
    hot = cut(rows.groupBy(key).agg(F.count("*").alias("count")).filter(F.col("count") > block).select(*[F.col(c).alias(f"hot_{c}") for c in key], F.ceil(F.col("count") / block).alias("blocks")), "hot-anchors")
    n_hot = hot.count()
    rows = rows.select(*key, F.lit(0).cast("long").alias("pair"), F.lit(False).alias("crossed"), F.lit(0).cast("long").alias("mine"), "word", "n")
    if n_hot:
        side, zero = F.broadcast(hot) if n_hot <= broadcast_keys else hot, F.lit(0).cast("long")
        rows = rows.join(side, [F.col(c) == F.col(f"hot_{c}") for c in key], "left").withColumn("blocks", F.coalesce("blocks", zero + 1))
        rows = rows.select(*key, F.pmod(F.xxhash64("word"), F.col("blocks")).alias("mine"), F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("other"), "blocks", "word", "n")
        rows = rows.select(*key, (F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")).alias("pair"), (F.col("mine") != F.col("other")).alias("crossed"), "mine", "word", "n")
    dealt = rows.repartition(*key, "pair").sortWithinPartitions(*key, "pair")
    return dealt.mapInArrow(near_batches, "word string, n long, near string, near_n long")


def roots(forms: DataFrame, broadcast_bytes: int = 1 << 25) -> DataFrame:
    """word and root (the last form reached) of each word that has a form. forms: word and form.

    Chains are short, since each form is several times as frequent as the one before; each round doubles
    the steps and keeps what has arrived out of the join.
    """
    spark = forms.sparkSession
    moving, arrived = cut(forms.select("word", F.col("form").alias("root")), "forms"), None
    while True:
        size = moving.agg(F.coalesce(F.sum(F.octet_length("word") + F.octet_length("root") + 32), F.lit(0))).first()[0]
        steps = moving.select(F.col("word").alias("at"), F.col("root").alias("to"))
        after = cut(moving.join(F.broadcast(steps) if size <= broadcast_bytes else steps, F.col("root") == F.col("at"), "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "forms")
        drop_table(spark, moving)
        moving = after
        if moving.filter("moved").isEmpty():
            return moving.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, least_n: int = 5, ratio: int = 5, one_in: int | None = None, block: int = 4_000) -> DataFrame:
    """word, n, n_near, form, form_n and root of each word. With one_in, that share of the words first loses a
    letter, picked by checksums, so that there are known misspellings to find."""
    if least < LEAST:
        raise ValueError(f"words of fewer than {LEAST} letters can lose both anchors to one edit")
    ship(docs.sparkSession)
    words = cut(word_counts(docs, least, least_n, one_in, id_col, text_col), "words")
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("form"))))
    seen = alone.union(near_words(words, block)).groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    has = -F.col("best.order") >= ratio * F.col("n")
    named = cut(seen.select("word", "n", "n_near", F.when(has, F.col("best.form")).alias("form"), F.when(has, -F.col("best.order")).alias("form_n")), "formed")
    ends = roots(named.filter("form is not null")).withColumnRenamed("word", "of")
    return named.join(ends, F.col("word") == F.col("of"), "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
