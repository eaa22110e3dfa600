"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written


def _stars(pairs: DataFrame) -> DataFrame:
    """(u, v, least): each pair with the least of u and its neighbours in ``pairs``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    return pairs.join(least, "u")  # AQE splits a node with very many neighbours


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the least node reachable.

    Each round is written to the shared folder, so a lost executor costs a part of
    one round. The number of rounds grows with the logarithm of the longest path.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now, before = written(now, "edges"), None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_stars(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")), "edges")
        each = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("least").alias("v")), F.struct("u", F.col("least").alias("v"))))
        now = written(_stars(large).select(each.alias("e")).select("e.*").where("u <> v").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).collect()[0]
        if before == (state["n"], state["h"]):
            break
        before = (state["n"], state["h"])
    ended = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ended.unionAll(ended.select(F.col("root").alias("node"), "root").distinct())
