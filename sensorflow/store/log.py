"""Commit log of an output root: one small record per commit, the newest one is the whole state.

A batch is written to folders of its own attempt first; its record then names them, together
with the ledger, the dimension and the layout after it.  Readers start from the newest record
alone, so what an attempt wrote is seen all at once or not at all, and a replay that fails
leaves the earlier attempt in place.  Records are never changed; two writers that start from
the same record get the same number, and the second one fails.

A record's size follows the batches that aren't compacted yet and the landing folders still
open, not the history: compacted files are listed in a layout file of their own, which is
written only by a compaction.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from sensorflow.store.files import Folder

#: records per folder of the log, so that finding the newest lists few names
PER_FOLDER = 100


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the state."""


@dataclass
class State:
    version: int = 0
    #: number of batches committed; they are numbered from 0 without gaps
    n_batches: int = 0
    #: ``[batch, attempt, [tables]]`` of batches whose folders aren't compacted
    attempts: list = field(default_factory=list)
    #: batch -> attempt that counts, for batches committed again after they were compacted
    redone: dict = field(default_factory=dict)
    #: ``[last intake, mark]`` in ascending order: landing rows of these intakes up to the mark are done
    #: (``[received_at in microseconds, id]``, or None: all)
    marks: list = field(default_factory=list)
    #: ``[number, intake, hour]`` of the landing folders that may hold rows above their mark
    open: list = field(default_factory=list)
    #: folder of ids (with intake and time) that are done although they are above the mark
    tail: str | None = None
    #: folder of the sensor dimension
    dimension: str | None = None
    #: layout file of the compacted tables
    layout: str | None = None


def numbered(n: int) -> str:
    return f"{n // PER_FOLDER:09d}/{n:011d}.json"


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = Folder(spark, self.root)

    def latest(self) -> State:
        for group in reversed(self.folder.names("_log")):
            records = [n for n in self.folder.names(f"_log/{group}") if n.endswith(".json")]
            if records:
                return State(**json.loads(self.folder.read(f"_log/{group}/{records[-1]}")))
        return State()

    def commit(self, after: State) -> State:
        """Make ``after``, a change of the newest state, the newest one."""
        after.version += 1
        if not self.folder.create(f"_log/{numbered(after.version)}", json.dumps(asdict(after))):
            raise CommitConflict(f"version {after.version} of {self.root} is another writer's")
        return after

    def layout(self, state: State) -> dict:
        """table -> partition value -> ``[level, folder]`` of its compacted files."""
        return json.loads(self.folder.read(state.layout)) if state.layout else {}

    def plan(self, batch: int, content: dict | None = None) -> dict | None:
        """The batch's plan: the first one written counts, for its replays too."""
        name = f"_plans/{numbered(batch)}"
        if content is not None:
            self.folder.create(name, json.dumps(content))
        text = self.folder.read(name)
        return json.loads(text) if text else None
