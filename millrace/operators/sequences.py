"""Rows by their place: ordinals, frames side by side, and probes of numbered pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.workspace import written

#: Ranges of a probe: their ends are what one task orders.
RANGES, LEAST_WIDTH = 65_536, 4096


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """df with the place of each row, from 0, in a total order; null comes first.

    Rows are sorted in ranges and numbered inside them; only the count of each range is summed up in one task. The
    ranges are written, since drawn again they could end elsewhere. Rows that tie are in an arbitrary order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__at")), "ranged")
    first = F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = placed.groupBy("__part").count().select(F.col("__part").alias("__of"), first.alias("__before"))
    return placed.join(F.broadcast(before), F.col("__part") == F.col("__of")).select(*df.columns, (F.col("__before") + F.col("__at")).alias(name))


def side_by_side(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """The k-th row of one frame beside the k-th of the other, with `ordinal`; they need share no column.

    Frames of different lengths don't belong together, which is an error. Two empty frames give an empty one.
    """
    a, b = written(with_ordinal(left, left_order), "left"), written(with_ordinal(right, right_order, "right_ordinal"), "right")
    if (n := a.count()) != (m := b.count()):
        raise ValueError(f"{n} rows can't stand beside {m}")
    return a.join(b, F.col("ordinal") == F.col("right_ordinal")).drop("right_ordinal")


def probed(found: DataFrame, id_col: str, first: int, last: int, step: int, misses: int, after_first_hit: bool = True) -> DataFrame:
    """The ids that a probe of first, first + step, ... last meets before it gives up, which is after `misses` ids in
    a row that aren't there; with after_first_hit those before the first hit don't count.

    Ids outside the probe, repeated ones and nulls are no hits. Gaps are found inside ranges of ids, and between
    ranges from their ends, so no task holds all ids.
    """
    width = max(LEAST_WIDTH, ((last - first) // step + RANGES) // RANGES)
    at = F.col(id_col).cast("long") - first
    hits = found.filter(F.col(id_col).between(first, last) & (at % step == 0)).select(F.expr(f"(cast({id_col} as bigint) - {first}) div {step}").alias("slot")).distinct()
    hits = hits.withColumn("range", F.expr(f"slot div {width}"))
    inside = hits.select("slot", (F.col("slot") - F.lag("slot").over(Window.partitionBy("range").orderBy("slot"))).alias("gap"))
    ends = hits.groupBy("range").agg(F.min("slot").alias("low"), F.max("slot").alias("high"))
    before = F.lag("high").over(Window.orderBy("range"))
    start = F.lit(None).cast("long") if after_first_hit else F.lit(-1).cast("long")
    between = ends.select(F.col("low").alias("slot"), (F.col("low") - F.coalesce(before, start)).alias("gap"))
    stop = inside.union(between).filter(F.col("gap") > misses).agg(F.min("slot").alias("stop"))
    seen = hits.join(F.broadcast(stop), F.col("stop").isNull() | (F.col("slot") < F.col("stop")))
    return seen.select((F.col("slot") * step + first).alias(id_col))
