"""Rows dealt over all cores before costly work on each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Tasks for each core, so that uneven rows even out.
WAVES = 4


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over at least WAVES tasks for each core, and over as many as shuffles have.

    Narrow rows come in few files and row groups, and a scan gives each row group to one task; what is built and parsed
    from a row afterwards costs far more than to send it. The number is given, so that adaptive execution doesn't
    merge the small partitions again.
    """
    spark = df.sparkSession
    return df.repartition(max(WAVES * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
