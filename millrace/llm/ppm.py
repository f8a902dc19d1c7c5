"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to `order`, counted over all training documents with a grouped
sum. A context that has seen d different symbols T times gives a symbol seen c times c / (T + d), and
escapes to the context one byte shorter with d / (T + d) (method C); symbols that a longer context has
already offered are excluded from the counts of the shorter ones, and below order 0 the remaining bytes
are equally likely. 0xFF, which UTF-8 never holds, stands before and after each text, so the score is
the log10 probability of exactly this text.

No context is left out: the trie is a set of tables of (context, symbol) counts, one for each order, each
summed from the next longer one. What an order excludes is just what its child has seen, so the sums that
escapes need are one join of neighbouring orders (`level_tables`). Costs are worked out for each
(context, symbol) of the whole corpus: seen ones from their own context, others by walking up the orders
in a join each (`costs`). Hot short contexts are broadcast, since orders 0 to 2 have at most 65,536
contexts; longer ones are spread by the symbols before.

Documents meet these costs as they meet word counts: what makes up more than 1 / `frequent` of all
occurrences is fewer than `frequent` rows by arithmetic, whatever the corpus, and is broadcast; all else
is counted for each document and meets its costs in a shuffle join that no key can make hot. So nothing
is collected that grows with the input, and no model is built on the driver.

The base is a word-unigram score.

Edge cases: null text is empty (one end token, one end symbol); without any training token all words
are unknown and bytes equally likely; a null id counts as the empty string in the hold-out rule; equal
rows and ties get equal scores; very long texts are read in pieces of one document at most; an empty
table gives an empty table; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, ship

EDGE, ORDER = 0xFF, 4
#: Bytes of text handled at a time inside a task, and codes summed in it before they are passed on.
_STEP, _HELD = 1 << 21, 1 << 20
#: Stands for the end token; no word is empty.
END = ""


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def kinds_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order and the place of each value among them, as np.unique gives them. Only the distinct
    values are sorted; all of them are hashed, which costs less where most come again, as grams do."""
    at, kinds = pd.factorize(values)
    order = np.argsort(kinds)
    rank = np.empty(len(kinds), np.int64)
    rank[order] = np.arange(len(kinds))
    return kinds[order], rank[at]


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of about _STEP bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + _STEP)))
        yield start, texts.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Tokens of each text and the flat tokens: words with A-Z lower-cased, then one end each."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    real = pc.not_equal(flat, "")
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)[real.to_numpy(zero_copy_only=False)]
    return owner, flat.filter(real)


def grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position: `order` bytes of context and the symbol as one number; and the text it is in."""
    pieces = [t.as_py() or b"" for t in texts.cast(pa.binary())]
    edge = bytes([EDGE]) * order
    x = np.frombuffer(edge + edge.join(pieces) + edge, np.uint8)
    m = len(x) - order
    code = x[:m].astype(np.int64)
    for k in range(1, order + 1):
        code <<= 8
        code |= x[k : k + m]
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    keep, ends = np.ones(m, bool), np.cumsum(lengths + order)
    for k in range(1, order):
        keep[ends - k] = False  # the text and one end stay, not the edges after it
    return code[keep], np.repeat(np.arange(len(pieces), dtype=np.int32), lengths + 1)


COUNTS = "word string, code long, n long, m long"


def _counts(words: pa.Array, codes: np.ndarray, n: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    word = pa.concat_arrays([words.cast(pa.string()), pa.nulls(len(codes), pa.string())])
    code = pa.concat_arrays([pa.nulls(len(words), pa.int64()), pa.array(codes)])
    return pa.RecordBatch.from_arrays([word, code, pa.array(n, pa.int64()), pa.array(m, pa.int64())], ["word", "code", "n", "m"])


def count_batches(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Counts of words (code null; training texts only) and of grams (word null): n in training texts, m in all.

    Grams are summed within a task. Batches: text, whether it is held out.
    """
    none = pa.array([], pa.string())
    held, n, m = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for start, texts in _slices(batch.column(0)):
            out = batch.column(1).slice(start, len(texts)).to_numpy(zero_copy_only=False)
            learned = texts.filter(pa.array(~out))
            counts = pc.value_counts(words_of(learned)[1])
            words, c = pa.concat_arrays([counts.field("values"), pa.array([END], pa.string())]), np.append(counts.field("counts").to_numpy(), len(learned))
            yield _counts(words, held[:0], c, c)
            code, owner = grams(texts, order)
            new, at = kinds_of(code)
            new_m = np.bincount(at, minlength=len(new))
            new_n = new_m - np.bincount(at[out[owner]], minlength=len(new))
            held, at = kinds_of(np.concatenate([held, new]))
            n = np.bincount(at, weights=np.concatenate([n, new_n]), minlength=len(held)).astype(np.int64)
            m = np.bincount(at, weights=np.concatenate([m, new_m]), minlength=len(held)).astype(np.int64)
            if len(held) > _HELD:
                yield _counts(none, held, n, m)
                held, n, m = held[:0], n[:0], m[:0]
    yield _counts(none, held, n, m)


def _low(code: Column, size: int) -> Column:
    """The last `size` bytes of a code."""
    return code.bitwiseAND(F.lit((1 << 8 * size) - 1))


def level_tables(codes: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per order 0 to `order`: (code, n) of context and symbol; and (context, total, kinds, below, below_kinds).

    codes: code, n. total and kinds are T and d of the context; below and below_kinds those of the context
    one byte shorter without the symbols that this one has seen.
    """
    seen = [cut(codes.filter("n > 0").select("code", "n"), "lm-level")]
    for k in range(order - 1, -1, -1):
        seen.insert(0, cut(seen[0].groupBy(_low(F.col("code"), k + 1).alias("code")).agg(F.sum("n").alias("n")), "lm-level"))
    contexts = []
    for k, mine in enumerate(seen):
        rows = mine.withColumn("shorter", F.lit(0).cast("long"))
        if k:
            other = seen[k - 1].select(F.col("code").alias("low"), F.col("n").alias("low_n"))
            rows = mine.join(F.broadcast(other) if k <= 2 else other, _low(F.col("code"), k) == F.col("low")).select("code", "n", F.col("low_n").alias("shorter"))
        sums = rows.groupBy(F.shiftright("code", 8).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("shorter").alias("taken"))
        if k:
            above = contexts[k - 1].select(F.col("context").alias("low"), F.col("total").alias("low_total"), F.col("kinds").alias("low_kinds"))
            sums = sums.join(F.broadcast(above) if k <= 3 else above, _low(F.col("context"), k - 1) == F.col("low"))
            sums = sums.select("context", "total", "kinds", (F.col("low_total") - F.col("taken")).alias("below"), (F.col("low_kinds") - F.col("kinds")).alias("below_kinds"))
        else:
            sums = sums.select("context", "total", "kinds", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("below_kinds"))
        contexts.append(cut(sums, "lm-contexts"))
    return seen, contexts


def costs(codes: DataFrame, order: int) -> DataFrame:
    """code and cost, the log10 probability of the symbol after its context, for each code. codes: code, n, m."""
    seen, contexts = level_tables(codes, order)
    done: list[DataFrame] = []
    # weight: log10 of the escapes so far; of the symbols that no longer context has seen, apart is T + d and
    # free is d at this order (null where no longer context is known); seen_kinds is d of the last context
    long = F.lit(None).cast("long")
    todo = codes.select("code", F.lit(0.0).alias("weight"), long.alias("apart"), long.alias("free"), F.lit(0).cast("long").alias("seen_kinds"))
    for k in range(order, -1, -1):
        sums = contexts[k].select(F.col("context").alias("c"), "total", "kinds", "below", "below_kinds")
        mine = seen[k].select(F.col("code").alias("s"), "n")
        todo = todo.join(F.broadcast(sums) if k <= 2 else sums, F.shiftright(_low(F.col("code"), k + 1), 8) == F.col("c"), "left")
        todo = todo.join(F.broadcast(mine) if k <= 1 else mine, _low(F.col("code"), k + 1) == F.col("s"), "left")
        todo = todo.withColumns({"apart": F.coalesce("apart", F.col("total") + F.col("kinds")), "free": F.coalesce("free", "kinds")})
        todo = cut(todo.select("code", "weight", "apart", "free", "seen_kinds", "kinds", "below", "below_kinds", "n"), "lm-costs")
        done.append(todo.filter("n is not null").select("code", (F.col("weight") + F.log10("n") - F.log10("apart")).alias("cost")))
        known, escapes = F.col("kinds").isNotNull(), F.col("free") > 0
        todo = todo.filter("n is null").select(
            "code",
            F.when(known & escapes, F.col("weight") + F.log10("free") - F.log10("apart")).otherwise(F.col("weight")).alias("weight"),
            F.when(known, F.col("below") + F.col("below_kinds")).alias("apart"),
            F.when(known, F.col("below_kinds")).alias("free"),
            F.when(known, F.col("kinds")).otherwise(0).alias("seen_kinds"),
        )
    done.append(todo.select("code", (F.col("weight") - F.log10(256 - F.col("seen_kinds"))).alias("cost")))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _spread(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each value in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def document_batches(batches: Iterator[pa.RecordBatch], shared, order: int) -> Iterator[pa.RecordBatch]:
    """id, text hash, tokens, and of the frequent words and codes: tokens, their base score and the model's."""
    words, logs, codes, code_costs = shared.value
    for batch in batches:
        for start, texts in _slices(batch.column(2)):
            owner, flat = words_of(texts)
            at = pc.index_in(flat, value_set=words)
            known = at.is_valid().to_numpy(zero_copy_only=False)
            part = logs[pc.fill_null(at, 0).to_numpy(zero_copy_only=False)] * known if len(logs) else np.zeros(len(known))
            m = len(texts)
            n = np.bincount(owner, minlength=m) + 1
            code, of = grams(texts, order)
            kinds, back = kinds_of(code)
            place, found = _spread(kinds, codes)
            cost = np.where(found, code_costs[place], 0.0) if len(codes) else np.zeros(len(kinds))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, m), batch.column(1).slice(start, m), pa.array(n, pa.int64()), pa.array(np.bincount(owner, weights=known, minlength=m).astype(np.int64)), pa.array(np.bincount(owner, weights=part, minlength=m)), pa.array(np.bincount(of, weights=cost[back], minlength=m))],
                ["doc_id", "h", "n_tokens", "n_known", "part", "score"],
            )


def _per_text(owner: np.ndarray, kinds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, kind, times) of the pairs."""
    pair, times = np.unique(owner.astype(np.int64) * max(1, n) + kinds, return_counts=True)
    return pair // max(1, n), pair % max(1, n), times


def rare_batches(batches: Iterator[pa.RecordBatch], shared, order: int) -> Iterator[pa.RecordBatch]:
    """id, text hash, word or code, and times in the text, of all that is not frequent."""
    words, _, codes, _ = shared.value
    for batch in batches:
        for start, texts in _slices(batch.column(2)):
            owner, flat = words_of(texts)
            rare = pc.is_null(pc.index_in(flat, value_set=words))
            owner, flat = owner[rare.to_numpy(zero_copy_only=False)], flat.filter(rare)
            coded = flat.dictionary_encode()
            at, kind, times = _per_text(owner, coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary))
            code, of = grams(texts, order)
            kinds, back = kinds_of(code)
            new = np.flatnonzero(~_spread(kinds, codes)[1])
            number = np.full(len(kinds), -1)
            number[new] = np.arange(len(new))
            number = number[back]
            code_at, code_kind, code_times = _per_text(of[number >= 0], number[number >= 0], len(new))
            text = pa.array(start + np.concatenate([at, code_at]))
            word = pa.concat_arrays([coded.dictionary.take(pa.array(kind)).cast(pa.string()), pa.nulls(len(code_at), pa.string())])
            code = pa.concat_arrays([pa.nulls(len(at), pa.int64()), pa.array(kinds[new][code_kind])])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(text), batch.column(1).take(text), word, code, pa.array(np.concatenate([times, code_times]), pa.int64())], ["doc_id", "h", "word", "code", "tf"])


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = 1_000_000, frequent_codes: int = 4_000_000, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row. order: 1 to 6."""
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text, F.octet_length(text)).alias("h"), text.alias("text"))
    raw = rows.select("text", held_out(F.col("doc_id")).alias("out")).mapInArrow(lambda b: count_batches(b, order), COUNTS)
    counted = cut(raw.groupBy("word", "code").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "lm-counts")
    words = counted.filter("word is not null").select("word", "n")
    n, v = (int(x or 0) for x in words.filter("n > 0").agg(F.sum("n"), F.count("*")).first())
    codes = counted.filter("code is not null").select("code", "n", "m")
    total = int(codes.agg(F.sum("m")).first()[0] or 0)
    priced = cut(costs(codes, order).join(codes.select(F.col("code").alias("of"), "m"), F.col("code") == F.col("of")).select("code", "cost", "m"), "lm-priced")
    top = words.filter(F.col("n") * frequent > n).toArrow()  # fewer than `frequent`
    top_n = top.column("n").to_numpy()
    top_codes = priced.filter(F.col("m") * frequent_codes > total).select("code", "cost").orderBy("code").toArrow()  # fewer than `frequent_codes`
    shared = spark.sparkContext.broadcast((top.column("word").combine_chunks(), np.log10(top_n + 0.1), top_codes.column("code").to_numpy(), top_codes.column("cost").to_numpy()))
    del top_codes
    ends = int(words.filter(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    scored = rows.mapInArrow(lambda b: document_batches(b, shared, order), "doc_id long, h long, n_tokens long, n_known long, part double, score double")
    rare = rows.mapInArrow(lambda b: rare_batches(b, shared, order), "doc_id long, h long, word string, code long, tf long")
    # a word's key is its text, a code's its number; the costs of both are one table
    of_words = words.filter((F.col("n") * frequent <= n) & (F.col("n") > 0)).select("word", F.lit(None).cast("long").alias("code"), F.lit(1).alias("known"), F.log10(F.col("n") + F.lit(0.1)).alias("value"))
    of_codes = priced.filter(F.col("m") * frequent_codes <= total).select(F.lit(None).cast("string").alias("word"), "code", F.lit(0).alias("known"), F.col("cost").alias("value"))
    values = of_words.union(of_codes).select(F.coalesce("word", F.lit("")).alias("v_word"), F.coalesce("code", F.lit(-1).cast("long")).alias("v_code"), "known", "value")
    rare = rare.select("doc_id", "h", F.coalesce("word", F.lit("")).alias("word"), F.coalesce("code", F.lit(-1).cast("long")).alias("code"), "tf")
    met = rare.join(values, (F.col("word") == F.col("v_word")) & (F.col("code") == F.col("v_code")), "left")
    is_code = F.col("code") >= 0
    unknown = F.lit(math.log10(0.1))
    parts = met.select(
        "doc_id", "h", F.lit(None).cast("long").alias("n_tokens"), (F.col("tf") * F.coalesce("known", F.lit(0))).alias("n_known"),
        F.when(is_code, 0.0).otherwise(F.col("tf") * F.coalesce("value", unknown)).alias("part"), F.when(is_code, F.col("tf") * F.col("value")).otherwise(0.0).alias("score"),
    )
    both = scored.union(parts)
    # equal rows meet here; their sums are shared out again
    out = both.groupBy("doc_id", "h").agg(F.count("n_tokens").alias("rows"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("known"), F.sum("part").alias("part"), F.sum("score").alias("score"))
    base = F.col("part") / F.col("rows") + F.lit(math.log10(ends + 0.1)) - F.col("n_tokens") * F.lit(math.log10(n + 0.1 * (v + 1)))
    out = out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.expr("known div rows") + int(ends > 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") / F.col("rows")).alias("score"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"))
    return out.drop("copy")
