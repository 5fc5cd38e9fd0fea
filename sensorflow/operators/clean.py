"""Clean step (C1-C9): keep-first dedup, validation, dead-letter split.

Order of the checks is fixed: dedup on the raw ``(sensor_id, timestamp)`` text
first (no dead letter for dropped repeats), then the first failing rule wins:

1. ``null value``           value missing
2. ``null timestamp``       timestamp missing
3. ``unparseable timestamp`` no known layout matches
4. ``non-numeric value``    value is not a number / boolean
5. ``value out of valid range for sensor_type``  (type compared lower-cased,
   inclusive bounds, NaN fails, types without a rule pass)

The whole classification is one projection producing a nullable ``reason``;
clean and dead-letter outputs are two filters over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow import rules
from sensorflow.functions.columns import numeric_value_sql, order_columns, parse_event_time_sql


def dedup_keep_first(flat: DataFrame, keys: Sequence[str] = ("sensor_id", "timestamp")) -> DataFrame:
    """One row per ``keys`` (NULLs equal), the earliest by ``(received_at, id)``.

    ``row_number() = 1``: the group limit keeps one row per key in each map task
    before the shuffle, so a hot key (e.g. every NULL timestamp of one chatty
    sensor) never lands whole in one task, and columns nobody reads are pruned.
    The window is partitioned by copies of the keys: a later filter on a key
    itself is then not evaluated before the dedup.
    """
    copies = [f"_key{i}" for i in range(len(keys))]
    order = [c.asc_nulls_first() for c in order_columns(flat)]
    first = F.row_number().over(Window.partitionBy(*copies).orderBy(*order))
    return (flat.withColumns({c: F.col(k) for c, k in zip(copies, keys)})
            .withColumn("_nth", first).filter("_nth = 1").select(*flat.columns))


def range_violation_sql(type_sql: str, value_sql: str,
                        ranges: Mapping[str, tuple[float, float]] = rules.VALID_RANGES) -> str:
    """SQL text: TRUE when a rule exists for ``lower(type)`` and the value is outside it."""
    if not ranges:
        return "false"
    arms = " ".join(f"WHEN lower({type_sql}) = '{name}' THEN NOT ({value_sql} BETWEEN {lo!r}D AND {hi!r}D)"
                    for name, (lo, hi) in ranges.items())
    return f"coalesce(CASE {arms} ELSE false END, false)"


def classify(flat: DataFrame, ranges: Mapping[str, tuple[float, float]] = rules.VALID_RANGES,
             timestamp_formats: Sequence[str] = rules.EXTRA_TIMESTAMP_FORMATS,
             dedup: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Dedup + one ``reason`` column (NULL = clean) + typed ``_value`` / ``_event_ts``.

    ``by`` (e.g. ``("batch_id",)``) keeps repeats in different batches apart,
    reproducing batch-local runs over a whole table.
    """
    df = flat
    extra = []
    if "payload" not in df.columns:
        extra.append("CAST(NULL AS STRING) AS payload")
    if "unit" not in df.columns:
        extra.append("CAST(NULL AS STRING) AS unit")
    if dict(df.dtypes).get("timestamp") == "string":
        ts = parse_event_time_sql("`timestamp`", timestamp_formats)
    else:
        ts = "CAST(`timestamp` AS TIMESTAMP)"
    # parsed before the dedup's shuffle, which holds the results: no filter above repeats the parse
    df = df.selectExpr("*", *extra, f"{ts} AS _event_ts", f"{numeric_value_sql(df, 'value')} AS _value")
    if dedup:
        df = dedup_keep_first(df, ("sensor_id", "timestamp", *by))
    reason = f"""CASE WHEN value IS NULL THEN '{rules.REASON_NULL_VALUE}'
                      WHEN `timestamp` IS NULL THEN '{rules.REASON_NULL_TIMESTAMP}'
                      WHEN _event_ts IS NULL THEN '{rules.REASON_BAD_TIMESTAMP}'
                      WHEN _value IS NULL THEN '{rules.REASON_NON_NUMERIC}'
                      WHEN {range_violation_sql('sensor_type', '_value', ranges)}
                        THEN '{rules.REASON_OUT_OF_RANGE}' END AS reason"""
    return df.selectExpr("*", reason)


def clean_rows(classified: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows without a reason, projected to the ``CLEAN`` schema (+ ``keep``)."""
    recv = F.col("received_at") if "received_at" in classified.columns else F.lit(None).cast("timestamp")
    return classified.filter(F.col("reason").isNull()).select(
        F.col("id").cast("long").alias("raw_event_id"),
        F.col("sensor_id").cast("string"),
        F.col("sensor_type").cast("string"),
        F.col("_value").alias("value"),
        F.col("unit").cast("string"),
        F.col("_event_ts").alias("event_ts"),
        recv.alias("received_at"),
        *[F.col(c) for c in keep],
    )


def dead_letter_rows(classified: DataFrame) -> DataFrame:
    """Rejected rows ``(raw_event_id, payload text, reason)``; NULL payload -> ``None``."""
    return classified.filter(F.col("reason").isNotNull()).select(
        F.col("id").cast("long").alias("raw_event_id"),
        F.coalesce(F.col("payload").cast("string"), F.lit("None")).alias("payload"),
        F.col("reason"),
    )


def clean_events(flat: DataFrame, ranges: Mapping[str, tuple[float, float]] = rules.VALID_RANGES,
                 timestamp_formats: Sequence[str] = rules.EXTRA_TIMESTAMP_FORMATS
                 ) -> tuple[DataFrame, DataFrame]:
    """``FLAT`` rows -> ``(CLEAN rows, DEAD_LETTER rows)``.

    Both outputs derive from one classified plan; a caller writing both should
    write :func:`classify` once (the batch plan does).
    """
    c = classify(flat, ranges, timestamp_formats)
    return clean_rows(c), dead_letter_rows(c)
