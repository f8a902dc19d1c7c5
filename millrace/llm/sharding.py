"""Proportional stratified interleaving into shards, with DataFrame functions only.

Rows are shuffled within each source by a seeded hash and ranked; row r of a source with n rows gets
the fractional rank (r + u) / n, where u is a seeded number of the source in [0, 1): without it the single
rows of all small sources would have one rank and stand together. Sorted by fractional rank, every stretch of rows holds the sources
in the proportions of the whole, so the order is cut into shards whose counts differ by one at most
(law `rows`).

Neither ranking puts a source or the whole table in one task: ranks are taken within buckets of the
sort key that hold about ROWS_PER_BUCKET rows, and added to the count of the buckets before. Those
counts are summed in two levels, so a task holds at most the sums of WIDE buckets, or one row for each
WIDE buckets of the table. The text itself is never shuffled; its size and checksum are taken in the scan.

Edge cases: null text has size 8 and checksum 0; a null source is a stratum of its own; null and repeated
ids are spread by the checksum of their texts, and rows that tie in both are in arbitrary order, which
changes no row of the result; repeated rows each get their own slot; very long texts count by their
bytes; an empty table gives an empty table; fewer rows than shards leave some shards empty; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut

ROWS_PER_BUCKET, WIDE = 2048, 2048


def with_rank(df: DataFrame, group: list[str], bucket: Column, order: list[str], rank: str, total: str) -> DataFrame:
    """Add the 0-based rank within the group and the group's size. bucket must not fall along the order."""
    rows = df.withColumn("__bucket", bucket)
    keys = [*group, "__bucket"]
    high = F.floor(F.col("__bucket") / WIDE)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n")).withColumn("__high", high)
    tops = counts.groupBy(*group, "__high").agg(F.sum("__n").alias("__top_n"))
    first = Window.unboundedPreceding, -1
    of_group = [F.col(k) for k in group] or [F.lit(0)]
    tops = tops.select(
        *[F.col(k).alias(f"__top_{k}") for k in [*group, "__high"]],
        F.coalesce(F.sum("__top_n").over(Window.partitionBy(*of_group).orderBy("__high").rowsBetween(*first)), F.lit(0)).alias("__top_before"),
        F.sum("__top_n").over(Window.partitionBy(*of_group)).alias(total),
    )
    inside = F.coalesce(F.sum("__n").over(Window.partitionBy(*group, "__high").orderBy("__bucket").rowsBetween(*first)), F.lit(0))
    over = F.lit(True)
    for k in [*group, "__high"]:
        over = over & F.col(k).eqNullSafe(F.col(f"__top_{k}"))
    counts = counts.withColumn("__inside", inside).join(tops, over)
    counts = counts.select(*[F.col(k).alias(f"__{k}") for k in keys], (F.col("__top_before") + F.col("__inside")).alias("__before"), total)
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = rows.join(counts, match).withColumn(rank, F.col("__before") + inside - 1)
    return out.select(*df.columns, rank, total)


def shard(docs: DataFrame, shards: int = 24, seed: int = 20, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law) of each row."""
    text = F.coalesce(docs[text_col], F.lit(""))
    crc = F.crc32(F.encode(text, "utf-8"))
    mixed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), docs[id_col], crc), 32)
    rows = cut(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].alias("source"), (F.octet_length(text).cast("long") + 8).alias("size"), crc.alias("text_crc32"), mixed.alias("mixed")), "shard-rows")
    n = rows.count()
    buckets = n // rows_per_bucket + 1
    order = ["mixed", "doc_id", "size", "text_crc32"]
    offset = F.crc32(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))), "utf-8")) / F.lit(1 << 32)
    ranked = with_rank(rows, ["source"], F.shiftright(F.col("mixed") * buckets, 32), order, "r", "of_source")
    ranked = cut(ranked.withColumn("fraction", (F.col("r") + offset) / F.col("of_source")).drop("r", "of_source"), "shard-ranked")
    placed = with_rank(ranked, [], F.floor(F.col("fraction") * buckets), ["fraction", "source", *order], "position", "of_all")
    number = F.expr(f"position * {shards} div {max(n, 1)}")
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", number).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("position") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
