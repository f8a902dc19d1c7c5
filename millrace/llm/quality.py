"""Quality rules with host verdicts, with DataFrame functions only.

Each document gets its counts and its own failures. Failures are then summed by host; the rate of
each host is shrunk by an empirical beta prior, so a host with few documents is judged mostly by what
is usual. The prior is that of a beta-binomial by moments: its mean is the pooled rate of all documents,
and its strength comes from the variance between hosts that is left once the sampling noise of each
host's own number of documents is taken out. A host is flagged if the lower bound of its posterior
(`deviations` standard deviations under its mean) is over `excess` times the pooled rate. The verdict is
joined back: a document of a flagged host must also pass the soft rules (symbols, repeated lines, mean
word length), one of any other host only the base rules. A clean document is therefore kept on every
host, and where no host stands out none is flagged.

The counts come from one pass over each text without a shuffle: five-word windows are hashed inside
the row, and positions are looked at only where a hash occurs twice. Hosts are aggregated from the
narrow counts with partial sums, so a host with a third of all rows is no hot spot.

Edge cases: null text has no words and fails; a null host is a host of its own; ties and repeated
rows are judged one by one; very long texts are read whole, their windows inside the row; an empty table
gives an empty table; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, let, settled

WINDOW = 5
SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The stretches between ASCII white space."""
    return F.array_remove(F.split(F.translate(text, SPACES[:-1], " " * 5), " "), "")


def window_hashes(words: Column, size: int) -> Column:
    """A hash for each window of `size` words; null where there are fewer words."""
    return let(words, lambda w: F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))))


def covered(hashes: Column) -> Column:
    """How many words lie in windows whose hash is there twice; positions are sorted only for these."""

    def repeated(pairs: Column) -> Column:
        twice = F.transform(pairs, lambda x, k: F.when((x["h"] == F.get(pairs, k - 1)["h"]) | (x["h"] == F.get(pairs, k + 1)["h"]), x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum"))
        return F.aggregate(F.sort_array(F.array_compact(twice)), start, lambda acc, p: F.struct(p.alias("last"), (acc["sum"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("sum")), lambda acc: acc["sum"])

    def inside(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(pairs, repeated)).otherwise(0)

    return F.coalesce(let(hashes, inside), F.lit(0))


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def document_stats(docs: DataFrame, carry: Column, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """carry, host, the counts of each whole text, and the failures of the base and the soft rules."""
    text = F.coalesce(docs[text_col], F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    rows = docs.select(carry.alias("carry"), docs[host_col].alias("host"), words_of(text).alias("w"), lines.alias("lines"), F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"), (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    rows = rows.select("carry", "host", "word_chars", "n_symbols", F.size("w").cast("long").alias("n_words"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.size("lines").cast("long").alias("n_lines"), window_hashes(F.col("w"), WINDOW).alias("h"))
    rows = rows.withColumn("n_repeat_words", covered(F.col("h")).cast("long"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    soft = (10 * F.col("n_symbols") > F.col("n_words")) | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")) | (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 10 * F.col("n_words"))
    return rows.select("carry", "host", *STATS, base.alias("base_failed"), soft.alias("soft_failed"))


#: Bounds of the prior's strength in documents: nothing known of hosts, and all hosts alike.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6


def host_verdicts(stats: DataFrame, excess: float = 1.5, deviations: float = 3.0) -> DataFrame:
    """host, docs, failed, the shrunk failure rate, its lower bound, the pooled rate, and whether the host is flagged.

    With k hosts, n of N documents each, x of X failed, and p = X / N: the sum of n (x / n - p)^2 is on
    average p (1 - p) (k - 1 + r (N - sum(n^2) / N - k + 1)), where r is the correlation of two documents
    of a host; r gives the strength a + b = 1 / r - 1. One host, or hosts that differ by no more than
    chance, have r = 0 and the greatest strength.
    """
    hosts = stats.groupBy("host").agg(F.count("*").alias("docs"), F.count_if(F.col("base_failed") | F.col("soft_failed")).alias("failed"))
    n, x = F.col("docs").cast("double"), F.col("failed").cast("double")
    sums = hosts.agg(F.sum(n).alias("n"), F.sum(x).alias("x"), F.count("*").cast("double").alias("k"), F.sum(n * n).alias("nn"), F.sum(x * x / n).alias("xx"))
    spread = F.try_divide(F.col("xx") - F.try_divide(F.col("x") * F.col("x"), F.col("n")), F.try_divide(F.col("x") * (F.col("n") - F.col("x")), F.col("n") * F.col("n")))
    r = F.try_divide(spread - (F.col("k") - 1), F.col("n") - F.try_divide(F.col("nn"), F.col("n")) - (F.col("k") - 1))
    strength = F.when(r > 0, F.greatest(F.lit(LEAST_STRENGTH), F.least(F.lit(MOST_STRENGTH), 1 / r - 1))).otherwise(F.lit(MOST_STRENGTH))
    prior = sums.select(F.try_divide("x", "n").alias("pooled_rate"), strength.alias("strength"))  # one row with two numbers
    out = hosts.join(F.broadcast(prior)).withColumn("shrunk_rate", (x + F.col("pooled_rate") * F.col("strength")) / (n + F.col("strength")))
    bound = F.col("shrunk_rate") - deviations * F.sqrt(F.col("shrunk_rate") * (1 - F.col("shrunk_rate")) / (n + F.col("strength") + 1))
    return out.select("host", "docs", "failed", "shrunk_rate", bound.alias("lower_bound"), "pooled_rate", (bound > excess * F.col("pooled_rate")).alias("host_flagged"))


def judged(docs: DataFrame, excess: float = 1.5, deviations: float = 3.0, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The counts, base_failed, the host's verdict and `kept` for each document."""
    stats = cut(document_stats(docs, docs[id_col].cast("long"), text_col, host_col), "quality")
    hosts = host_verdicts(stats, excess, deviations).select(F.col("host").alias("flagged_host"), "host_flagged")
    out = stats.join(hosts, F.col("host").eqNullSafe(F.col("flagged_host")), "left")
    return out.select(F.col("carry").alias("doc_id"), *STATS, "base_failed", (~F.col("base_failed") & ~(F.col("host_flagged") & F.col("soft_failed"))).alias("kept"), "soft_failed", "host_flagged")


def passing(docs: DataFrame, excess: float = 1.5, deviations: float = 3.0, text_col: str = "text", host_col: str = "source", broadcast_hosts: int = 100_000) -> DataFrame:
    """The documents that are kept, with their own columns.

    The texts are read twice (once for the hosts, once to filter) rather than shuffled or stored, and
    no id is needed. Flagged hosts are broadcast only if there are at most `broadcast_hosts` of them.
    """
    hosts = host_verdicts(document_stats(docs, F.lit(0), text_col, host_col), excess, deviations)
    flagged = cut(hosts.filter("host_flagged").select(F.col("host").alias("flagged_host")), "flagged-hosts")
    rows = settled(document_stats(docs, F.struct(*docs.columns), text_col, host_col)).filter(~F.col("base_failed") & (F.col("settled") >= 0))
    if n := flagged.count():
        side = F.broadcast(flagged) if n <= broadcast_hosts else flagged
        rows = rows.join(side, F.col("soft_failed") & F.col("host").eqNullSafe(F.col("flagged_host")), "left_anti")
    return rows.select("carry.*")
