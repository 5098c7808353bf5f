"""Connected components by alternating large-star and small-star steps, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import persisted, release


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, root) for each node that has an edge to another one; root is the least node of its component.

    Groups are never gathered: each step is a minimum per key and a join, both of which combine before the
    shuffle or can be split when skewed. Each round is written to the shared folder. Null ends are left out.
    """
    u, v = F.col(src), F.col(dst)
    e = edges.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    e, before = persisted(e, "edges"), None
    while (now := _digest(e)) != before and now[0]:
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, e = e, persisted(moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        release(last)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _digest(e: DataFrame) -> tuple:
    row = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return (row[0], row[1])
