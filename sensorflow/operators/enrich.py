"""Enrich step (E1-E9): calendar features + sensor dimension join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sensorflow import schemas
from sensorflow.functions.columns import parse_event_time, wall_clock_features
from sensorflow.operators.joins import dimension_join


def time_features(clean: DataFrame) -> DataFrame:
    """``hour_of_day``, ``day_of_week`` (0 = Monday), ``is_business_hours`` (UTC)."""
    df = clean
    if dict(df.dtypes).get("event_ts") == "string":
        df = df.withColumn("event_ts", parse_event_time(F.col("event_ts"), ()))
    feats = wall_clock_features("event_ts")
    keep = [c for c in df.columns if c not in feats]
    return df.select(*keep, *[c.alias(n) for n, c in feats.items()])


def _dimension_columns(metadata: DataFrame) -> DataFrame:
    cols = [F.col("sensor_id")]
    for name in schemas.METADATA_JOINED:
        t = dict((f.name, f.dataType) for f in schemas.METADATA.fields)[name]
        cols.append((F.col(name) if name in metadata.columns else F.lit(None)).cast(t).alias(name))
    return metadata.select(*cols)


def enrich_events(clean: DataFrame, metadata: DataFrame, join: Callable[..., DataFrame] = dimension_join) -> DataFrame:
    """Clean rows -> ``ENRICHED`` rows.

    ``join`` is :func:`dimension_join`, or :func:`hot_key_join` for a large dimension.

    Left join on ``sensor_id`` keeping location, zone, min/max expected and the
    baseline (the dimension's ``sensor_type`` is not kept).  Unknown sensors and
    an empty dimension give NULLs; the output schema is the same either way.
    """
    df = time_features(clean)
    for name in schemas.METADATA_JOINED:
        if name in df.columns:
            df = df.drop(name)
    return join(df, _dimension_columns(metadata), "sensor_id", "left")


def with_baseline(enriched: DataFrame, metadata: DataFrame) -> DataFrame:
    """Add ``baseline_events_per_min`` from the dimension when it is missing."""
    if "baseline_events_per_min" in enriched.columns:
        return enriched
    dim = metadata.select("sensor_id", F.col("baseline_events_per_min").cast("double"))
    return dimension_join(enriched, dim, "sensor_id", "left")


def enrich_quality(enriched: DataFrame, metrics: Observation) -> DataFrame:
    """Row count and rows without a zone, collected in ``metrics`` by the job that computes the frame."""
    return enriched.observe(metrics, F.count(F.lit(1)).alias("rows"),
                            F.count_if(F.col("zone").isNull()).alias("rows_without_zone"))
