"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import saved


#: Links of one partition. Few links need few partitions, and with one no exchange.
PARTITION_LINKS = 200_000


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other"))
    )))


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of the component.

    Every join is between links and one row per node. A hub's links are only ever reduced to their minimum or
    joined with one row. Not settling within ``max_rounds`` is an error, never a partial answer.
    """
    links = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(max_rounds):
        row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (row.n, row.h) == mark:
            break
        mark = (row.n, row.h)
        links = links.coalesce(max(1, -(-row.n // PARTITION_LINKS)))
        both = _both(links)
        least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("m"))
        large = both.where("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = saved(hung.unionByName(least.withColumnRenamed("m", "b")).where("a <> b").distinct())
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
