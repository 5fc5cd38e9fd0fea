"""Landing-table scans and the payload flatten."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow import rules, schemas
from sensorflow.session import ensure_last_key_wins

def unprocessed_batch(landing: DataFrame, limit: int | None = rules.BATCH_LIMIT,
                      processed_ids: DataFrame | None = None) -> DataFrame:
    """Rows not yet processed, oldest first, at most ``limit``.

    ``processed`` is the landing flag; ``processed_ids`` (column ``id``) is the
    append-only ledger written by :func:`sensorflow.sinks.tables.mark_processed`,
    applied as an anti join.  The order key ``(received_at, id)`` is unique, so
    the capped batch is deterministic; ``orderBy + limit`` plans as a top-N
    (``TakeOrderedAndProject``) without a global sort.  ``limit=None`` returns
    every pending row.
    """
    pending = landing.filter(~F.coalesce(F.col("processed"), F.lit(False)))
    if processed_ids is not None:
        pending = pending.join(processed_ids.select("id"), "id", "left_anti")
    if limit is None:
        return pending
    return pending.orderBy(F.col("received_at").asc_nulls_last(), F.col("id").asc_nulls_last()).limit(limit)


def flatten_payload(landing: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Landing row -> ``FLAT`` row.

    ``value``, ``unit`` and ``timestamp`` come from the JSON payload, read as a variant:
    of duplicate keys the last one wins.  The payload is written again in one form, without
    white space between tokens and with its keys in order, so equal objects have equal text.
    A payload that is not a JSON object counts as ``{}``.  ``sensor_id`` / ``sensor_type``
    fall back to the payload when the column is NULL or empty.
    """
    ensure_last_key_wins(landing.sparkSession)
    # One parse per row: the variant is materialised as a column (an expensive
    # producer referenced several times is not inlined by the optimizer).
    parsed = landing.withColumn("_p", F.when(F.ltrim(F.col("payload"), F.lit(" \t\r\n")).startswith("{"),
                                             F.try_parse_json("payload")))
    body = F.coalesce(F.to_json("_p"), F.lit("{}"))

    def field(name: str):
        return F.try_variant_get(F.col("_p"), f"$.{name}", "string")

    def ident(name: str):
        return F.coalesce(F.nullif(F.col(name), F.lit("")), field(name))

    return parsed.select(
        F.col("id").cast("long").alias("id"),
        ident("sensor_id").alias("sensor_id"),
        ident("sensor_type").alias("sensor_type"),
        field("value").alias("value"),
        field("unit").alias("unit"),
        field("timestamp").alias("timestamp"),
        F.col("received_at"),
        body.alias("payload"),
        *[F.col(c) for c in keep],
    )


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet",
               columns: Sequence[str] | None = None) -> DataFrame:
    """Scan a table with a declared schema (no inference), pruned to ``columns``."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    if columns:
        df = df.select(*columns)
    return df


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({float(v)!r} AS DOUBLE)"


def rows_frame(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """Small fixed rows as a local relation (exact size statistics for the planner)."""
    names = schema.fieldNames()
    if not rows:
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return spark.range(1).select(*nulls).where(F.lit(False))  # known to be empty when planned: no task runs for it
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def seed_metadata(spark: SparkSession) -> DataFrame:
    """The seed sensor dimension as a DataFrame (6 rows)."""
    return rows_frame(spark, rules.SEED_SENSORS, schemas.METADATA)


def clean_by_ids(clean: DataFrame, ids: DataFrame, id_col: str = "raw_event_id") -> DataFrame:
    """Curated rows whose key is in ``ids`` (semi join), ordered by event time.

    The id set is a DataFrame, not a driver-side list, so it can be as large as
    the batch; Catalyst picks broadcast or shuffled semi join by size.
    """
    keys = ids.select(F.col(ids.columns[0]).alias(id_col))
    return clean.join(keys, id_col, "left_semi").orderBy("event_ts", id_col)


def from_records(spark: SparkSession, records: Iterable[dict] | Sequence[tuple],
                 schema=schemas.FLAT) -> DataFrame:
    """In-memory record list -> DataFrame with the declared ``FLAT`` schema."""
    rows = list(records)
    if rows and isinstance(rows[0], dict):
        names = schema.fieldNames()
        rows = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(rows, schema)
