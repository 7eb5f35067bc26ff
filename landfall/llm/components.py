"""Connected components of links, by stars that grow over the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _least(links: DataFrame) -> DataFrame:
    """Each node's smallest neighbour; tasks combine before the shuffle."""
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest one."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(_least(both), "a").filter("b > a")
    return near.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node's smaller neighbours, and itself, to the smallest one; a > b holds."""
    near = links.join(_least(links), "a")
    mine = near.select("a", F.col("least").alias("b"))
    others = near.filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return mine.unionByName(others).distinct()


def components(links: DataFrame) -> DataFrame:
    """`uid` and `root`, the smallest node of its component, for every node but the roots.

    `links` has `a` and `b`, in any order and number. Hot nodes are combined before
    they are shuffled, and joined by sort-merge joins, which split them.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, before = saved(ordered.distinct(), "links"), None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return current.select(F.col("a").alias("uid"), F.col("b").alias("root"))
        before = mark
        current = saved(_small_star(_large_star(current)), "links")
