"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import stored


def _least(neighbours: DataFrame) -> DataFrame:
    return neighbours.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
    return both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", limit: int = 60) -> DataFrame:
    """(id, root): each node of an edge with the least node of its component.  A node's neighbours are only reduced
    to their minimum and joined, so no component is gathered in one place.  Ends when a round changes nothing."""
    e = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "cc-edges")
    before = None
    for _ in range(limit):
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
        e = stored(small_star(large_star(e)), "cc-edges")
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
