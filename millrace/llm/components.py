"""Connected components of an edge table by alternating large-star and small-star steps.

Each round is a few joins over the edges and is written to the shared folder, so the lineage stays
short and a lost executor costs one round. Minima are taken with partial aggregates. Joining them back
would put all edges of a hub on one key, so hubs are kept out of that join: a vertex is one if it has
more than max(HUB, edges / HUBS) edges, of which there are at most 2 * HUBS, and these are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, drop_table

HUB, HUBS = 100_000, 500_000


def _to_least(edges: DataFrame, n: int, add_self: bool) -> DataFrame:
    """For u with neighbours v: link each v (and u itself) to the least of u and its neighbours. n: number of edges."""
    limit = max(HUB, n // HUBS)
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"), "degree")
    can_have_hubs = n > limit
    if can_have_hubs:
        least = cut(least, "least")
    hubs, others = least.filter(F.col("degree") > limit).select("k", "m"), least.filter(F.col("degree") <= limit).select("k", "m")
    if not can_have_hubs or hubs.isEmpty():
        links = edges.join(least if not can_have_hubs else others, F.col("u") == F.col("k"))
    else:
        marked = edges.join(F.broadcast(hubs), F.col("u") == F.col("k"), "left")
        rest = marked.filter("k is null").select("u", "v").join(others, F.col("u") == F.col("k"))
        links = marked.filter("k is not null").unionByName(rest)
    if add_self:  # small star: neighbours are below u
        out = links.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("k", "m"))
        out = out.filter("u <> v").distinct()
    else:
        out = links.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    out = cut(out, "edges")
    if can_have_hubs:
        drop_table(edges.sparkSession, least)
    return out


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and root (the least node that it can reach) for every node that has an edge.

    Null ends and edges from a node to itself are left out; repeated edges count once; no edges give an
    empty table.
    """
    spark = edges.sparkSession
    now = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == mark or found[0] == 0:
            break
        mark = found
        larger = _to_least(now.union(now.select("v", "u")), 2 * found[0], False)
        after = _to_least(larger, 2 * found[0], True)
        drop_table(spark, now)
        drop_table(spark, larger)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
