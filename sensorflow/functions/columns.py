"""Scalar column expressions shared by the operators.

Everything here returns a ``Column`` built from built-in functions, so it stays
inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow import rules


#: ISO text with a date: a year, then a separator or nothing
DATED = "^[0-9]{4}([-T ]|$)"
#: lower-case text of a number
NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?$|^[+-]?(nan|inf|infinity)$"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def parse_event_time_sql(text_sql: str, formats: Sequence[str] = rules.EXTRA_TIMESTAMP_FORMATS) -> str:
    """SQL text of :func:`parse_event_time` over the SQL expression ``text_sql``."""
    t = f"trim({text_sql})"
    tries = [f"CASE WHEN {t} RLIKE '{DATED}' THEN try_to_timestamp({t}) END"] + [f"try_to_timestamp({t}, '{f}')" for f in formats]
    return tries[0] if len(tries) == 1 else "coalesce(" + ", ".join(tries) + ")"


def parse_event_time(text: Column | str,
                     formats: Sequence[str] = rules.EXTRA_TIMESTAMP_FORMATS) -> Column:
    """Lenient text -> TIMESTAMP (UTC instant); NULL when nothing matches.

    The ISO-8601 family (date only, ``T`` or space separator, fractional seconds,
    ``Z`` or ``+hh:mm`` offsets) comes from the cast rules; zone-less text is read
    in the session time zone, which the pipeline pins to UTC.  Text without a date
    (``10:00:00``) doesn't count: the cast would add today's.  The extra layouts
    are tried in order afterwards.  ``text`` may be a column name or a Column.
    """
    if isinstance(text, str):
        return F.expr(parse_event_time_sql(_q(text), formats))
    c = F.trim(text)
    tries = [F.when(c.rlike(DATED), F.try_to_timestamp(c))] + [F.try_to_timestamp(c, F.lit(f)) for f in formats]
    return F.coalesce(*tries)


def numeric_value_sql(df: DataFrame, name: str = "value") -> str:
    """SQL text: reading value -> DOUBLE, NULL when not numeric.

    Strings must be decimal numbers, ``NaN`` or ``Infinity`` (the cast alone also
    takes Java literals such as ``22d`` and ``0x1p3``); ``true``/``false`` map to
    1.0/0.0; numeric and boolean columns are cast.
    """
    dtype = df.schema[name].dataType
    c = _q(name)
    if isinstance(dtype, (T.BooleanType, T.NumericType)):
        return f"CAST({c} AS DOUBLE)"
    s = f"lower(trim(CAST({c} AS STRING)))"
    return (f"CASE WHEN {s} = 'true' THEN 1.0D WHEN {s} = 'false' THEN 0.0D "
            f"WHEN {s} RLIKE '{NUMBER}' THEN try_cast({s} AS DOUBLE) END")


def order_columns(df: DataFrame, preferred: Sequence[str] = ("received_at", "raw_event_id", "id")) -> list[Column]:
    """Deterministic "input order": arrival time first, then the landing id."""
    cols = [c for c in preferred if c in df.columns]
    if not cols:
        raise ValueError(f"no ordering column among {list(preferred)}")
    return [F.col(c) for c in cols]


def order_key(df: DataFrame, preferred: Sequence[str] = ("received_at", "raw_event_id", "id")) -> Column:
    """:func:`order_columns` as one struct."""
    return F.struct(*order_columns(df, preferred))


def packed_order_key(df: DataFrame, time_col: str = "received_at",
                     id_cols: Sequence[str] = ("raw_event_id", "id")) -> Column | None:
    """``(time, id)`` packed into one ``DECIMAL(38,0)``: ``micros * 10^20 + (id + 2^63)``.

    Same order as the struct key, but fixed-width, so aggregates keyed on it
    (``min_by``) run as hash aggregates instead of sort aggregates.  Exact for
    every timestamp Spark can hold (|micros| < 3e17) and every long id.
    Returns None when the columns are not there.
    """
    ids = [c for c in id_cols if c in df.columns]
    if time_col not in df.columns or not ids or dict(df.dtypes)[time_col] != "timestamp":
        return None
    return F.expr(f"CAST(unix_micros({_q(time_col)}) AS DECIMAL(38,0)) * CAST({10 ** 20} AS DECIMAL(38,0))"
                  f" + (CAST({_q(ids[0])} AS DECIMAL(38,0)) + CAST({2 ** 63} AS DECIMAL(38,0)))")


def first_in_order(value: Column | str, key: Column) -> Column:
    """Value of the earliest row of a group (combines map-side like ``min``)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, key)


def iso_utc_text(ts: Column | str) -> Column:
    """ISO-8601 UTC text: microseconds printed only when non-zero, ``+00:00`` zone."""
    t = F.col(ts) if isinstance(ts, str) else ts
    micros = F.unix_micros(t)
    whole = F.pmod(micros, F.lit(1_000_000)) == 0
    return F.when(whole, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def wall_clock_features(ts: Column | str) -> dict[str, Column]:
    """hour_of_day (0-23), day_of_week (0 = Monday), is_business_hours."""
    t = F.col(ts) if isinstance(ts, str) else ts
    hour = F.hour(t).cast("int")
    dow = F.weekday(t).cast("int")
    business = ((hour >= rules.BUSINESS_HOUR_START) & (hour < rules.BUSINESS_HOUR_END)
                & (dow <= rules.LAST_BUSINESS_WEEKDAY))
    return {"hour_of_day": hour, "day_of_week": dow, "is_business_hours": business}
