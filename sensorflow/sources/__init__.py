"""Sources: message intake, landing scans, payload flatten, derived test feed."""

from sensorflow.sources.derived import derive_feed, derive_landing, derive_messages
from sensorflow.sources.intake import messages_to_landing, subscribe
from sensorflow.sources.landing import (
    clean_by_ids,
    flatten_payload,
    from_records,
    read_table,
    seed_metadata,
    unprocessed_batch,
)

__all__ = [
    "clean_by_ids", "derive_feed", "derive_landing", "derive_messages", "flatten_payload",
    "from_records", "messages_to_landing", "read_table", "seed_metadata", "subscribe",
    "unprocessed_batch",
]
