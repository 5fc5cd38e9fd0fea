"""Landing table by intakes, and the ledger of what is done as a low-water mark.

An intake is one micro-batch of one source: a folder with a sub-folder per hour of arrival, and,
once all is written, a numbered record that names these hours.  An intake of many hours has a
sub-folder per range of hours, named by the last of them, so its files follow its size and not
the time that it spans.  Records also carry the last batch of every source, so a batch that is
delivered again after its record changes nothing.

The ledger is a mark in the order ``(received_at, id)``, not a list of ids: a run takes the oldest
pending rows, which are a prefix of that order, so the last of them says all.  A mark holds for
the intakes recorded when it was set.  Rows that arrive later have no mark, however old they are.
Intakes with the same mark share one entry: as a rule there is one, and another for each late
intake that a run's limit has cut.

A run reads the new intakes, and of older ones the hours at or after their mark.  Ids that were
marked out of order are kept as a list until the mark has passed them.
"""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow import schemas
from sensorflow.sources.landing import rows_frame
from sensorflow.store.files import Folder
from sensorflow.store.log import PER_FOLDER, CommitConflict, State, numbered

HOUR = "yyyy-MM-dd-HH"
COLUMNS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.LANDING.fields) + ", intake string, hour string"
#: how rows are taken: oldest first
ORDER = ["received_at", "id"]
#: sub-folders of an intake; the hours of a longer one share them
FOLDERS = 32


def hour_folder(rows: DataFrame, most: int = FOLDERS) -> Column:
    """Name of each row's sub-folder: its hour of arrival or, of more than ``most`` hours, the last hour of its range.

    Ranges hold about as many rows each.  Only their limits come to the driver.
    """
    start = F.unix_seconds(F.date_trunc("hour", "received_at"))
    if rows.select(start.alias("start")).distinct().limit(most + 1).count() <= most:
        return F.date_format("received_at", HOUR)
    last = rows.agg(F.percentile_approx(start, [(k + 1) / most for k in range(most)])).first()[0]
    name = F
    for at in sorted(set(last)):
        name = name.when(start <= at, F.date_format(F.timestamp_seconds(F.lit(at)), HOUR))
    return name.otherwise(F.date_format("received_at", HOUR))


class Landing:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = Folder(spark, self.root)

    def _latest(self) -> dict:
        for group in reversed(self.folder.names("_intakes")):
            records = [n for n in self.folder.names(f"_intakes/{group}") if n.endswith(".json")]
            if records:
                return json.loads(self.folder.read(f"_intakes/{group}/{records[-1]}"))
        return {"number": -1, "sources": {}}

    def append(self, rows: DataFrame, batch: int, source: str = "stream") -> bool:
        """K1: land the rows of a source's batch; False if it had landed before.  A source's batches ascend."""
        if self._latest()["sources"].get(source, -1) >= batch:
            return False
        name, staging = f"{source}-{batch}", f"_staging/{uuid.uuid4().hex}"
        landed = F.coalesce(F.col("received_at"), F.current_timestamp())
        # once as it comes: a stream's own session can't rebalance, each of its tasks would write a file per sub-folder
        rows = rows.select(*schemas.LANDING.fieldNames()).withColumn("received_at", landed)
        rows.write.parquet(f"{self.root}/{staging}")
        rows = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{staging}")
        (rows.withColumn("hour", hour_folder(rows)).hint("rebalance", "hour")
         .write.mode("overwrite").partitionBy("hour").parquet(f"{self.root}/intake={name}"))
        self.folder.delete(staging)
        hours = [n.removeprefix("hour=") for n in self.folder.names(f"intake={name}") if n.startswith("hour=")]
        for _ in range(100):
            last = self._latest()
            record = {"number": last["number"] + 1, "name": name, "hours": hours, "sources": last["sources"] | {source: batch}}
            if self.folder.create(f"_intakes/{numbered(record['number'])}", json.dumps(record)):
                return True
        raise CommitConflict(f"too many writers land in {self.root}")

    def intakes(self, after: int = -1) -> list[dict]:
        """Records numbered above ``after``, in order."""
        found = []
        for group in self.folder.names("_intakes"):
            if int(group) >= (after + 1) // PER_FOLDER:
                found += [f"_intakes/{group}/{n}" for n in self.folder.names(f"_intakes/{group}")
                          if n.endswith(".json") and int(n.removesuffix(".json")) > after]
        return [json.loads(self.folder.read(n)) for n in found]

    def read(self, folders: list) -> DataFrame:
        """Rows of ``[number, intake, hour]`` folders; intake and hour are columns."""
        if not folders:
            return rows_frame(self.spark, [], T.StructType.fromDDL(COLUMNS))
        paths = [f"{self.root}/intake={name}/hour={hour}" for _, name, hour in folders]
        return self.spark.read.schema(COLUMNS).option("basePath", self.root).parquet(*paths)

    def all_rows(self) -> DataFrame:
        return self.read([[r["number"], r["name"], h] for r in self.intakes() for h in r["hours"]])

    def candidates(self, state: State) -> tuple[list, int]:
        """Folders that may hold pending rows, and the number of the last intake."""
        last = state.marks[-1][0] if state.marks else -1
        new = self.intakes(last)
        return (state.open + [[r["number"], r["name"], h] for r in new for h in r["hours"]],
                new[-1]["number"] if new else last)

    def rows_between(self, folders: list, marks: list, mark: list | None, tail: str | None) -> DataFrame:
        """Rows that aren't flagged, above the mark of their intake, up to ``mark`` (None: all), and not in ``tail``."""
        by_mark: dict = {}
        for f in folders:
            by_mark.setdefault(json.dumps(mark_of(marks, f[0])), []).append(f)
        parts = [self.read(fs).where(above(json.loads(m))) for m, fs in by_mark.items()]
        rows = reduce(DataFrame.unionAll, parts) if parts else self.read([])
        rows = rows.where(~F.coalesce("processed", F.lit(False)))
        if mark is not None:
            rows = rows.where(~above(mark) & (F.col("received_at") <= F.timestamp_micros(F.lit(mark[0]).cast("long"))))
        if tail:
            done = self.spark.read.parquet(tail).select("intake", "id")
            rows = rows.join(done, ["intake", "id"], "left_anti")
        return rows

    def pending(self, state: State) -> DataFrame:
        """Rows that aren't done yet."""
        return self.rows_between(self.candidates(state)[0], state.marks, None, state.tail)


NOTHING_DONE = "nothing"


def mark_of(marks: list, number: int):
    """The mark of an intake: ``[received_at in microseconds, id]``, None if all of it is done."""
    return next((m for upto, m in marks if number <= upto), NOTHING_DONE)


def above(mark) -> Column:
    """Rows after the mark in the order ``(received_at, id)``; the time alone is said too, for the scan's filter."""
    if mark == NOTHING_DONE:
        return F.lit(True)
    if mark is None:
        return F.lit(False)
    at = F.timestamp_micros(F.lit(mark[0]).cast("long"))
    since = F.col("received_at")
    return (since >= at) & ((since > at) | (F.col("id") > F.lit(mark[1]).cast("long")))


def advanced(marks: list, last: int, mark: list | None) -> list:
    """The marks after a run that took what is pending in intakes up to ``last``, up to ``mark`` (None: all)."""
    new = [[upto, None if m is None or mark is None else max(m, mark)] for upto, m in marks]
    if not new or new[-1][0] < last:
        new.append([last, mark])
    return [e for k, e in enumerate(new) if k + 1 == len(new) or new[k + 1][1] != e[1]]


def still_open(folders: list, marks: list) -> list:
    """Folders whose hour isn't wholly below the mark of their intake."""
    def is_open(number, hour):
        mark = mark_of(marks, number)
        if mark is None or mark == NOTHING_DONE:
            return mark == NOTHING_DONE
        return hour >= datetime.fromtimestamp(mark[0] // 1_000_000, UTC).strftime("%Y-%m-%d-%H")

    return [f for f in folders if is_open(f[0], f[2])]
