"""Connected components of a large sparse graph, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import dropped, shared_folder, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.where("b > a").join(least, "a").where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the bigint ``edges`` (a, b): the root is
    the smallest node that can be reached.

    Every step reads and writes a table in the shared folder; a hub's links
    are folded by a partial minimum and joined back, never gathered.
    """
    folder = shared_folder(edges.sparkSession, "components")
    now = written(edges.where("a <> b").select("a", "b").distinct(), "", f"{folder}/0")
    state, turn = _state(now), 0
    while True:
        turn += 1
        now = written(_small_star(_large_star(now)), "", f"{folder}/{turn}")
        before, state = state, _state(now)
        dropped(edges.sparkSession, [f"{folder}/{turn - 1}"])
        if state == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
