"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Texts become templates of two kinds. In both, case, ASCII punctuation and the kind of white space go, and
numbers and units after numbers are typed placeholders. In the second, capitalised words are placeholders too,
wherever they stand. So a question asked with other numbers or names still matches, and so does one whose
case or line breaks are changed (names that differ are found only if they keep their capitals). Windows
of `size` template tokens are hashed and joined with those of the benchmark. A window that is less than
half literal words says too little: it counts only where its very words are the same.

Where windows of a document and an item meet, the words behind the item's placeholders are lined up:
within one alignment a slot value of the item must always stand for the same value of the document and
the other way round, else the windows that break the rule do not count.

A document is contaminated by an item if at least `min_windows` of the item's windows (all of them,
if it has fewer) match on one alignment: with size 8 and 6 windows, 13 words in a row. An item of fewer
than `size` tokens is one window of its own length.

Documents are read in one narrow pass for the hash join, whatever the lengths; only those with enough
windows on one alignment are read again for their slots. Results are worked out once for each text, by a
hash of it, and given to all rows that hold it, so copies cost nothing more and rows with the same id
stay apart. The windows of the benchmark are broadcast if there are at most `broadcast_windows`, else
joined by a shuffle; so are the hashes of texts with a match, which keeps all other texts out of one.
An item that very many documents leak is one key of a join only where its slots are too many to
broadcast, and there it is salted.

Edge cases: null and blank texts match nothing, nor does an item without words; repeated items are
each reported; a row without an id is reported with a null id; repeated rows are reported once, and of
repeated ids with different texts what any of them leaks; ties between slot values go to the smaller one;
very long texts are read whole; an empty table gives an empty table; other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut

SPACES = "\t\n\x0b\x0c\r"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~€£"
NUMBER, UNIT, NAME = "‹n›", "‹u›", "‹c›"
NUMBERS, NAMES = r"^[0-9]+$", r"^\p{Lu}\p{Ll}+$"
UNITS = "mm cm m km g kg mg t ml l s min h hour hours minute minutes second seconds day days week weeks month months year years mile miles foot feet ft inch inches lb lbs pound pounds oz dollar dollars euro euros cent cents percent degree degrees watt watts kw kwh volt volts meter meters metre metres gram grams liter liters litre litres".split()
SALTS = 32


def tokens(text: Column) -> Column:
    """Words without ASCII punctuation, in their own case."""
    plain = F.translate(text, SPACES + PUNCTUATION, " " * len(SPACES))
    return F.array_remove(F.split(plain, " "), "")


def _plain(word: Column, before: Column) -> Column:
    """The word in lower case, or the placeholder of a number or of a unit after one."""
    low = F.lower(word)
    return F.when(word.rlike(NUMBERS), NUMBER).when(F.coalesce(before.rlike(NUMBERS), F.lit(False)) & low.isin(UNITS), UNIT).otherwise(low)


def plain_template(words: Column) -> Column:
    """Words with placeholders for numbers and units."""
    return F.transform(words, lambda w, i: _plain(w, F.get(words, i - 1)))


def name_template(words: Column, plain: Column) -> Column:
    """The same with placeholders for capitalised words."""
    return F.zip_with(words, plain, lambda w, p: F.when(w.rlike(NAMES) & (p != UNIT), NAME).otherwise(p))


def window_hashes(ids: Column, size: Column | int) -> Column:
    """The hash of each window of `size` token hashes, in order; none where there are fewer."""
    length = F.lit(size) if isinstance(size, int) else size
    return F.transform(F.when(F.size(ids) >= length, F.sequence(F.lit(1), F.size(ids) - length + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.xxhash64(F.slice(ids, i, length)))


def with_ids(df: DataFrame, views: set[str], text_col: str = "text") -> DataFrame:
    """df with the token hashes of its text in the views raw, plain and names.

    Hashes of template tokens are taken from the words at once; a text without digits has no numbers to look for.
    """
    out = df.withColumn("words", tokens(F.col(text_col)))
    some = F.transform("words", lambda w, i: F.xxhash64(_plain(w, F.get("words", i - 1))))
    none = F.transform("words", lambda w: F.xxhash64(F.lower(w)))
    out = out.withColumn("plain", F.when(F.col(text_col).rlike("[0-9]"), some).otherwise(none))
    if "names" in views:
        name, unit = F.xxhash64(F.lit(NAME)), F.xxhash64(F.lit(UNIT))
        out = out.withColumn("names", F.zip_with("words", "plain", lambda w, h: F.when(w.rlike(NAMES) & (h != unit), name).otherwise(h)))
    if "raw" in views:
        out = out.withColumn("raw", none)
    return out.drop("words")


def with_templates(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with the tokens of its text (raw, in lower case) and of its two templates (plain, names); all line up."""
    out = df.withColumn("words", tokens(F.col(text_col)))
    out = out.withColumn("plain", plain_template(F.col("words")))
    return out.select(*df.columns, F.transform("words", lambda w: F.lower(w)).alias("raw"), "plain", name_template(F.col("words"), F.col("plain")).alias("names"))


def text_key(text: Column) -> Column:
    return F.xxhash64(text, F.octet_length(text))


def item_windows(items: DataFrame, size: int, item_col: str, text_col: str) -> DataFrame:
    """item_id, it (hash of its text), length, n (windows of the item), view, at and h."""
    rows = items.select(items[item_col].cast("long").alias("item_id"), F.coalesce(items[text_col], F.lit("")).alias("text"))
    rows = with_templates(rows).filter(F.size("raw") > 0).withColumn("length", F.least(F.size("raw"), F.lit(size)))
    length = F.col("length")

    def literal(words: Column, at: Column) -> Column:
        return 2 * F.size(F.filter(F.slice(words, at + 1, length), lambda w: ~F.startswith(w, F.lit("‹")))) >= length

    r, p, q = (F.transform(v, lambda w: F.xxhash64(w)) for v in ("raw", "plain", "names"))
    rows = rows.withColumns({"r": window_hashes(r, length), "p": window_hashes(p, length), "q": window_hashes(q, length)})
    rows = rows.select("item_id", text_key(F.col("text")).alias("it"), "length", (F.size("raw") - length + 1).alias("n"), "plain", "names", F.posexplode(F.arrays_zip("r", "p", "q")).alias("at", "w"))
    at = F.col("at")
    plain = F.struct(F.when(literal(F.col("plain"), at), "plain").otherwise("raw").alias("view"), F.when(literal(F.col("plain"), at), F.col("w.p")).otherwise(F.col("w.r")).alias("h"))
    other = F.when((F.col("w.q") != F.col("w.p")) & literal(F.col("names"), at), F.struct(F.lit("names").alias("view"), F.col("w.q").alias("h")))
    return rows.select("item_id", "it", "length", "n", "at", F.explode(F.array_compact(F.array(plain, other))).alias("v")).select("item_id", "it", "length", "n", "v.view", "at", "v.h")


def _leaking_texts(docs: DataFrame, items: DataFrame, size: int, min_windows: int, broadcast_windows: int, text_col: str, item_col: str) -> DataFrame:
    """t (hash of a text), item_id, matched and item_windows."""
    bench = cut(item_windows(items, size, item_col, text_col), "benchmark-windows")
    kinds = bench.groupBy("view", "length").count().collect()  # 3 views, `size` lengths
    small = sum(r["count"] for r in kinds) <= broadcast_windows

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= broadcast_windows else df

    rows = docs.select(F.coalesce(docs[text_col], F.lit("")).alias("text")).select(text_key(F.col("text")).alias("t"), "text")
    views = sorted({(r.view, r.length) for r in kinds}) or [("plain", size)]
    spots = with_ids(rows, {v for v, _ in views}).select("t", F.explode(F.array(*[window_hashes(F.col(v), k) for v, k in views])).alias("d")).select("t", F.posexplode("d").alias("pos", "dh"))
    found = spots.join(F.broadcast(bench) if small else bench, F.col("dh") == F.col("h"))
    hits = cut(found.select("t", "item_id", "it", "length", "n", "at", (F.col("pos") - F.col("at")).alias("shift")).distinct(), "window-hits")
    alignment = ["t", "item_id", "it", "shift"]
    enough = F.least(F.lit(min_windows), F.col("n"))
    lined = hits.groupBy(*alignment).agg(F.count("*").alias("c"), F.first("n").alias("n")).filter(F.col("c") >= enough).select(*[F.col(k).alias(f"a_{k}") for k in alignment])
    same = F.lit(True)
    for k in alignment:
        same = same & F.col(k).eqNullSafe(F.col(f"a_{k}"))
    hits = cut(hits.join(lined, same, "left_semi"), "aligned-hits")

    # the words behind the placeholders
    own = items.select(items[item_col].cast("long").alias("s_item"), F.coalesce(items[text_col], F.lit("")).alias("text"))
    slots = with_templates(own).select("s_item", text_key(F.col("text")).alias("s_it"), F.explode(F.arrays_zip("raw", "names", F.sequence(F.lit(0), F.greatest(F.size("raw") - 1, F.lit(0))).alias("i"))).alias("s"))
    slots = slots.filter(F.startswith("s.names", F.lit("‹"))).select("s_item", "s_it", F.col("s.i").alias("item_at"), F.col("s.names").alias("kind"), F.col("s.raw").alias("item_value")).distinct()
    matched = side(hits.select(F.col("t").alias("m")).distinct())
    said = with_templates(rows.join(matched, F.col("t") == F.col("m"), "left_semi").dropDuplicates(["t"])).select(F.col("t").alias("in_text"), F.posexplode("raw").alias("doc_at", "doc_value"))
    met = F.col("item_id").eqNullSafe(F.col("s_item")) & (F.col("it") == F.col("s_it"))
    if small:
        pairs = hits.join(F.broadcast(slots), met)
    else:
        slots = slots.withColumn("s_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        pairs = hits.withColumn("salt", F.pmod(F.col("t"), F.lit(SALTS)).cast("int")).join(slots, met & (F.col("salt") == F.col("s_salt")))
    pairs = pairs.filter((F.col("item_at") >= F.col("at")) & (F.col("item_at") < F.col("at") + F.col("length")))
    pairs = pairs.join(said, (F.col("t") == F.col("in_text")) & (F.col("doc_at") == F.col("item_at") + F.col("shift"))).select(*alignment, "at", "kind", "item_at", "item_value", "doc_value")
    votes = pairs.drop("at").distinct().groupBy(*alignment, "kind", "item_value", "doc_value").agg(F.count("*").alias("votes"))

    # the value that most places agree on is the slot's; a window with any other one is inconsistent
    def best(key: str) -> Column:
        return F.row_number().over(Window.partitionBy(*alignment, "kind", key).orderBy(F.desc("votes"), "item_value", "doc_value"))

    odd = votes.withColumn("x", best("item_value")).withColumn("y", best("doc_value")).filter("x > 1 or y > 1").select(*[F.col(k).alias(f"a_{k}") for k in alignment], *[F.col(k).alias(f"a_{k}") for k in ("kind", "item_value", "doc_value")])
    alike = same
    for k in ("kind", "item_value", "doc_value"):
        alike = alike & (F.col(k) == F.col(f"a_{k}"))
    broken = pairs.join(odd, alike, "left_semi").select(*[F.col(k).alias(f"a_{k}") for k in alignment], F.col("at").alias("a_at")).distinct()
    good = hits.join(broken, same & (F.col("at") == F.col("a_at")), "left_anti")
    good = good.groupBy(*alignment).agg(F.countDistinct("at").alias("matched"), F.first("n").alias("n")).filter(F.col("matched") >= enough)
    return good.groupBy("t", "item_id").agg(F.max("matched").cast("long").alias("matched"), F.max("n").cast("long").alias("item_windows"))


def leaks(docs: DataFrame, items: DataFrame, size: int = 8, min_windows: int = 6, broadcast_windows: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """doc_id, item_id, matched (windows of the item found), item_windows: one row per document and leaked item."""
    found = cut(_leaking_texts(docs, items, size, min_windows, broadcast_windows, text_col, item_col), "leaking-texts").withColumnRenamed("t", "leaking")
    side = F.broadcast(found) if found.count() <= broadcast_windows else found
    ids = docs.select(docs[id_col].cast("long").alias("doc_id"), text_key(F.coalesce(docs[text_col], F.lit(""))).alias("t"))
    out = ids.join(side, F.col("t") == F.col("leaking")).groupBy("doc_id", "item_id")
    return out.agg(F.max("matched").alias("matched"), F.max("item_windows").alias("item_windows"))


def clean(docs: DataFrame, items: DataFrame, size: int = 8, min_windows: int = 6, broadcast_windows: int = 1_000_000, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The documents that leak no item, with their own columns; no id is needed."""
    found = cut(_leaking_texts(docs, items, size, min_windows, broadcast_windows, text_col, item_col).select(F.col("t").alias("leaking")).distinct(), "leaking-texts")
    side = F.broadcast(found) if found.count() <= broadcast_windows else found
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("own"), text_key(F.coalesce(docs[text_col], F.lit(""))).alias("t"))
    return keyed.join(side, F.col("t") == F.col("leaking"), "left_anti").select("own.*")
