"""Connected components of a graph given by its links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicarium.llm.common import dropped, staged


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): each linked node with the smallest node it can reach.

    Rounds of large-star and small-star: all larger neighbours of a node, then
    all smaller ones, are linked to the smallest neighbour instead, until
    only stars are left. Rounds grow with the logarithm of the component.
    A node with very many links is combined before its shuffle in each
    aggregation, whose totals are written, and so a skewed join key that AQE splits.
    """
    now = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _sum(now)
    while seen[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "nearest")
        large = staged(both.join(nearest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-stars")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = staged(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        for done in (now, nearest, large, least):
            dropped(done)
        now, then, seen = after, seen, _sum(after)
        if seen == then:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _sum(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1] or 0
