"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twintally.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node it reaches.

    ``edges`` has (a, b) longs. Each round points all larger neighbours of a
    node, then all smaller ones, to the smallest; neighbours are never gathered
    in one row, so a node of very many edges is just many rows. Rounds grow with
    the logarithm of the longest chain.
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                 "cc")
    mark = state(now)
    while mark[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(small.union(least.select("k", "m")).where("u <> v").distinct(), "cc")
        before, mark = mark, state(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
