"""Storage of a deployment: landing intakes, a commit log over all tables, compaction, the ledger's mark."""

from sensorflow.store.landing import Landing
from sensorflow.store.log import CommitConflict, CommitLog, State
from sensorflow.store.runs import mark_done, replay, run_pending, seed_dimension
from sensorflow.store.tables import compact, read_dimension, read_table

__all__ = ["CommitConflict", "CommitLog", "Landing", "State", "compact", "mark_done", "read_dimension", "read_table", "replay",
           "run_pending", "seed_dimension"]
