"""Connected components over an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rematerialize, salted_join

#: Tasks that the links of one node are dealt over where they meet the node's smallest neighbour.
SALTS = 16


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links -> (node, root): the smallest node of its component for every node that is
    not itself the smallest. Nulls and loops are left out.

    Each round hangs every node's larger neighbours under its smallest one, then its smaller
    neighbours; rounds are written to the shared checkpoint folder, and the loop ends when a
    round changes nothing, which takes about log2 of the longest path."""
    a, b = F.greatest("u", "v"), F.least("u", "v")
    now = rematerialize(edges.where("u <> v").select(a.alias("u"), b.alias("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (salted_join(both.where("v > u"), least, ["u"], F.xxhash64("v"), SALTS)
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(large, low, ["u"], F.xxhash64("v"), SALTS).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = rematerialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
