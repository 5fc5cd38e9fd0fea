"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import dealt_anew
from sensorflow.session import staged


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour (or itself) of each ``u``."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).select(dealt_anew("u"), "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable, for every node of an edge but the smallest itself.

    ``edges`` has longs ``u, v`` in any direction, repeats and loops allowed.  Only a count
    and a sum per round reach the driver; each round's edges are a written table.
    """

    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = staged(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                 "edges")
    before, state = None, digest(now)
    while state != before:
        now = staged(_small_star(_large_star(now).distinct()).distinct(), "edges")
        before, state = state, digest(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
