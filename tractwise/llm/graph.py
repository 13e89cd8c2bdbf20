"""Connected components of any size by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tractwise.llm.tables import Stored


def components(edges: DataFrame, stored: Stored) -> DataFrame:
    """The smallest node reachable from each node of ``edges`` (``u``, ``v``).

    Returns ``node`` and ``component`` for every node that has an edge to another one.
    Alternates the large-star and small-star steps of Kiveris et al. (2014) until the
    edges no longer change. Minima are aggregated before they are shuffled and joined
    back, so the neighbours of a node never meet in one task. NULL ends and loops are
    left out.
    """
    u, v = F.col("u"), F.col("v")
    now = stored(
        edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    )
    before = None
    while True:
        state = now.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v") % 1_000_003), F.lit(0)),
            F.coalesce(F.sum(F.xxhash64("v", "u") % 999_983), F.lit(0)),
        ).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v"))
            .where(u != v).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where(v != F.col("m"))
            .select(v.alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        done, now = now, stored(small)
        stored.drop(done)
    return now.select(u.alias("node"), v.alias("component")).unionByName(
        now.select(v.alias("node"), v.alias("component")).distinct()
    )
