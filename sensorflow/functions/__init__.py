"""Column-level building blocks (pure Spark SQL expressions, no Python UDFs)."""

from sensorflow.functions.columns import (
    first_in_order,
    iso_utc_text,
    order_key,
    parse_event_time,
    wall_clock_features,
)

__all__ = [
    "first_in_order",
    "iso_utc_text",
    "order_key",
    "parse_event_time",
    "wall_clock_features",
]
