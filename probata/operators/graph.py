"""Operators on links between keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import cut, dropped


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the least node reachable from each linked node, roots included.

    links: (a, b) of one ordered type. Alternates two steps that keep components and end in stars:
    larger neighbours are linked to the least neighbour, then smaller ones are. Each step's table is written to the
    shared folder and removed once the next one stands. Nulls and links of a node with itself are dropped. Links that do not
    settle in so many rounds are an error (each round shortens paths by far more than half in practice).
    """
    links = cut(links.toDF("a", "b").filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    for _ in range(rounds):
        both = links.union(links.select("v", "u").toDF("u", "v"))
        # A table of its own: a node with many links is then a join key that can be split.
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut(both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        dropped(links, least)
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        near = large.join(least, "u")
        small = near.filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        links = cut(small.distinct())
        dropped(large, least)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select("v", "v").distinct())
