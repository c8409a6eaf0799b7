"""Connected components of a link table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; ``root`` is the smallest node reachable.

    Two alternating steps that link every node to its smallest neighbour
    (large star, then small star) until nothing changes, in a number of rounds
    that grows with the logarithm of the longest chain. The smallest neighbour
    of each node is a grouping with a map-side step. It is written before it
    is joined, so a node with very many links is an ordinary skewed join key.
    """
    links = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = materialize(links, "components")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                            .select("u", F.least("u", "m").alias("m")), "components-least")
        large = (both.join(least, "u").where("v > u AND v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large, "components")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "components-least")
        small = (large.join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))
                 .where("u > v").distinct())
        small = materialize(small, "components")
        state = small.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"),
                          F.count_distinct("u").alias("nodes")).first()
        # one link for each node, and the same links as after the round before
        if state["n"] == 0 or state["n"] == state["nodes"] and (state["n"], state["h"]) == before:
            break
        before = (state["n"], state["h"])
        links = small
    roots = small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return small.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
