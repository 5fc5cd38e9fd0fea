"""sensorflow: validate, enrich and monitor sensor events on Spark.

Public operators (all ``DataFrame -> DataFrame``):

* ``sources``   message intake, landing-table scans, payload flattening
* ``operators`` clean (dedup + dead letters), enrich, anomaly detectors
* ``sinks``     idempotent appends, processed ledger, dimension seeding
* ``plans``     the batch plan wiring the stages together
* ``streaming`` the same plan per micro-batch with ``foreachBatch``
"""

from sensorflow.session import ensure_utc, get_session

__all__ = ["ensure_utc", "get_session"]
