"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import drop, materialise


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) for every node with an edge; nodes are longs.

    Each round hangs the larger neighbours of a node on its smallest neighbour and then all its smaller ones. A round
    never adds edges beyond those it had, and a logarithmic number of rounds in the size of a component is enough. Each
    round's edges are a table in the shared folder, so a lost executor costs one round; nothing is collected, and a table
    goes once the next one is written. Chains of n nodes settle within about log2(n) + 2 rounds; a graph that has not
    settled after `rounds` (60 by default, far beyond any) is an error, never a wrong result.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    before = last = None
    for n in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        now = materialise(small, f"star-{n}")
        if last is not None:
            drop(last)
        last = now
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
