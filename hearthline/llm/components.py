"""Connected groups of a link table by alternating large and small stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hearthline.llm.common import stage


def groups(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and root (the smallest node of its group) for every node that has a link to another.

    Each round first hangs every larger neighbour of a node onto the smallest of its neighbourhood, then does the same
    among smaller ones. A node's smallest neighbour is an aggregate, then joined back, so a node with very many links is
    never gathered in one place. Ends when a round changes no link.
    """
    both = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    both = stage(both, "links")
    seen = None
    while True:
        # large star: with links in both directions, every larger neighbour of u goes to the smallest around u
        ways = both.select("u", "v").unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            smallest.select("u", F.col("m").alias("v"))
        )
        both = stage(small.distinct(), "links")
        state = tuple(both.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())
        if state == seen:
            return both.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
