"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.operators.staging import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the neighbourhood.

    What a node finds is written, here and below, so that the join has plain exchanges and
    Spark can split a node with very many neighbours.
    """
    both = links.union(links.select("low", "high")).toDF("node", "other")
    least = staged(both.groupBy("node").agg(F.min("other").alias("found")))
    moved = both.join(least, "node").where("other > node")
    return moved.select(F.col("other").alias("high"), F.least("node", "found").alias("low"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest one."""
    least = staged(links.groupBy("high").agg(F.min("low").alias("least")))
    moved = links.join(least, "high")
    return moved.select(
        F.explode(F.array(F.struct(F.col("high"), F.col("least").alias("low")), F.struct(F.col("low").alias("high"), F.col("least").alias("low")))).alias("link")
    ).select("link.high", "link.low")


def _clean(links: DataFrame) -> DataFrame:
    return links.where("high <> low").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for each node with a link.

    Links are two columns of equal type in any order and number; a null end or a link to
    itself is ignored. Each round is written to the shared folder, so lineage stays short;
    the number of rounds follows the logarithm of the longest chain. Only two numbers
    come to the driver in a round.
    """
    now = staged(
        _clean(links.where(f"{a} IS NOT NULL AND {b} IS NOT NULL").select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")))
    )
    before = _state(now)
    while True:
        now = staged(_clean(_small_star(staged(_clean(_large_star(now))))))
        after = _state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("low").alias("node")).distinct()
    return now.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
