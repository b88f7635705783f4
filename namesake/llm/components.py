"""Connected components of a table of links, by alternating large stars and small stars.

Every round rewrites the links so that they point to smaller nodes; the number of rounds grows with the logarithm of
the longest path.  Each round is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesake.llm.common import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of the links a, b (long)."""
    now = materialise(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        now = materialise(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    return now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
