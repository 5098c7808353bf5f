"""Consecutive numbers over a sorted table, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... in the given order, which must leave no ties.

    Rows are dealt by ranges, counted range by range, and each range goes on where the one before ends. What is
    broadcast is one number for each range.
    """
    ranges = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = ranges.withColumn("_nth", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n")).collect()
    before, starts = 0, {}
    for r in sorted(sizes, key=lambda r: r["_range"]):
        starts[r["_range"]] = before
        before += r["_n"]
    first = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]) if starts else F.create_map().cast("map<int,int>")
    return inside.withColumn(name, (F.coalesce(F.try_element_at(first, F.col("_range")), F.lit(0)) + F.col("_nth")).cast("long")).drop("_range", "_nth")
