"""Spark queries vs their DuckDB oracles on the smallest scale factor."""

import datetime as dt
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sensorflow.plans.oracle import oracle_queries
from sensorflow.plans.queries import registry

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(map(str, t)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{os.path.join(SF, 'events.parquet')}')")
    return c


def test_every_query_has_oracle():
    assert set(registry()) == set(oracle_queries())
    assert set(registry()) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", [n for n in registry() if n != "streaming_readings"])
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    r = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(r.columns)
    assert canon([tuple(x) for x in df.collect()], df.columns) == canon(r.fetchall(), r.columns)


def test_entry(spark):
    kinds = {r.anomaly_type for r in entry(spark).select("anomaly_type").distinct().collect()}
    assert kinds == {"temperature_zscore", "motion_burst", "door_outside_hours"}


def test_feed_ids_never_collide(spark):
    """1,200,000 events, beyond the size at which repeats once shared ids with rows."""
    from pyspark.sql import functions as F

    from sensorflow.sources.derived import derive_landing, derive_messages
    events = spark.range(1_200_000).select(F.col("id").alias("event_id"), (F.col("id") % 150).alias("user_id"),
                                           (F.col("id") % 97 * 0.5).alias("value"))
    ids = derive_landing(events).agg(F.count("id"), F.count_distinct("id")).first()
    assert ids[0] == ids[1] == 1_248_000
    assert derive_messages(events).agg(F.count_distinct("id")).first()[0] == 1_200_000
