"""Connected components of a distributed edge list, by alternating stars.

Each round links every larger neighbour of a node to the smallest one (large
star), then every smaller neighbour likewise (small star). Both are a partial
aggregation for the smallest neighbour and a join back, so no node's
neighbourhood is ever gathered in one place. The edges end as stars around the
smallest node of each component; a round that changes nothing ends the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.llm.common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge to another; component is the smallest node."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = cut(e, "edges")
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        low = low.select("w", F.least("m", "w").alias("m"))
        # large star: larger neighbours of u go to u's smallest
        big = e.select(F.col("v").alias("x"), F.col("u").alias("y"))  # y > x: y is a larger neighbour of x
        large = big.join(low, big.x == low.w).select(F.col("y").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = cut(large, "edges")
        small = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        j = large.join(small, large.u == small.w)
        out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select(F.col("w").alias("u"), F.col("m").alias("v")))
        seen = Observation()
        e = cut(out.filter("u <> v").distinct()
                .observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")), "edges")
        now = seen.get["n"], seen.get["x"]
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
