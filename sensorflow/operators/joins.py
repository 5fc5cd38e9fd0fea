"""Dimension joins: left to the planner, or with frequent keys apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a key with more than one in so many fact rows is frequent, so there are fewer such keys than this
FREQUENT = 256


def dimension_join(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Join a fact table to a dimension.

    Without a hint: Catalyst broadcasts a dimension whose estimate is within
    ``spark.sql.autoBroadcastJoinThreshold``, AQE one whose measured size is; any
    other joins by sort-merge on the key, where AQE splits a hot key of the fact side.
    """
    return fact.join(dim, on, how)


def hot_key_join(fact: DataFrame, dim: DataFrame, on: str, how: str = "left", frequent: int = FREQUENT) -> DataFrame:
    """Left join to a dimension too large to broadcast, whatever the share of one key.

    Keys with more than one in ``frequent`` fact rows are counted first; there are fewer than
    ``frequent`` of them.  Their dimension rows alone are broadcast, and their fact rows, like those
    without a key, stay where they are.  The rest is joined as the planner likes; no key of it has
    more than one in ``frequent`` of all rows.  ``dim`` is unique on ``on``.  ``fact`` is read three
    times: hand in a stored table, not a long plan.
    """
    if how != "left":
        raise ValueError("only left joins")
    counts = fact.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = [r[0] for r in counts.where(F.col("_n") * frequent > total).select(on).collect()]
    # a literal list of fewer than ``frequent`` keys: tests rows where they are read
    is_hot = F.col(on).isin(hot) if hot else F.lit(False)
    stays = F.col(on).isNull() | is_hot
    near = fact.where(stays).join(F.broadcast(dim.where(is_hot)), on, "left")
    return near.unionByName(fact.where(~F.coalesce(stays, F.lit(True))).join(dim.where(~is_hot), on, "left"))
