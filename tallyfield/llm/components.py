"""Connected components of an edge table by alternating large and small stars, each round in a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minimum(both).withColumn("m", F.least("u", "m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minimum(down)
    near = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, folder: str, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` for every node of an edge but the roots; a root is the smallest node of its component.

    Numbers of nodes are long. The rounds grow with the logarithm of the longest path; loops, repeated edges and an
    empty table are fine.
    """
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    now, before, turn = stage(now, folder, "edges-0"), None, 0
    while True:
        turn += 1
        now = stage(_small_star(_large_star(now)), folder, f"edges-{turn}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
