"""Connected components of an edge table, without gathering the graph anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import cut, partitions


def components(edges: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long): root is the smallest node reachable.

    Alternating star contraction: each round links every node to the smallest node it can see, first over its larger
    neighbours, then over its smaller ones.  The number of rounds grows with the logarithm of the graph, not with its
    diameter.  Smallest neighbours are found by an aggregation that reduces before it shuffles; each round is cut.  With
    ``rows_per_task`` a round of few edges takes no more tasks, and writes no more files, than these need.
    """
    a, b = F.col("a"), F.col("b")

    def fitted(frame: DataFrame, rows: int) -> DataFrame:
        if rows_per_task is None:
            return frame
        return frame.coalesce(max(1, min(partitions(frame.sparkSession), -(-rows // rows_per_task))))

    held = cut(edges.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    before = None
    while True:
        mark = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        held = fitted(held, mark[0])
        both = held.unionByName(held.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where(b > a).select(F.col("m").alias("a"), "b").where(a != b).distinct()
        large = fitted(cut(fitted(large, 2 * mark[0])), 2 * mark[0])
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        near = large.join(low, "b").select(F.col("m"), "a", "b")
        small = near.select(F.col("m").alias("a"), a.alias("b")).unionByName(near.select(F.col("m").alias("a"), "b"))
        held = cut(fitted(small.where(a != b).distinct(), 2 * mark[0]))
    roots = held.select(b.alias("node"), a.alias("root"))
    return roots.unionByName(held.select(a.alias("node"), a.alias("root")).distinct())
