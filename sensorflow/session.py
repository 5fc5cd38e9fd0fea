"""Session helpers: UTC session time zone, AQE, checkpoint directory."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (event times are UTC instants)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_last_key_wins(spark: SparkSession) -> SparkSession:
    """JSON objects that repeat a key are valid and its last value counts, as in a JSONB column."""
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sensorflow") -> SparkSession:
    """Session for tests, benchmarks and local runs.

    On a cluster the deployment supplies master, memory and checkpoint settings;
    only missing settings are filled here.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode runs every task inside the driver JVM (Spark's default heap is 1 GB)
            b = b.config("spark.driver.memory", os.environ.get("SENSORFLOW_DRIVER_MEMORY", "4g"))
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          # duplicate JSON keys: the last one wins, as in a JSONB column
          .config("spark.sql.variant.allowDuplicateKeys", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """True when driver and tasks share one process (``local`` or ``local[...]``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """Shared folder for checkpoints and staged tables.

    ``folder``, else the cluster's ``spark.checkpoint.dir``, is used as is.  When
    both are unset, a local session gets a scratch folder that is removed at exit;
    on a cluster that is an error, as executors would write to their own disks.
    """
    d = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sensorflow-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to a new table in the shared folder and read it back.

    Cuts lineage like ``checkpoint()``, but keeps columns prunable, filters
    pushable and no inherited partitioning, so a later join deals both sides anew
    and AQE can split a hot key.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/staged/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
