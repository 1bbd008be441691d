"""A table kept as its change batches on top of a snapshot: plain Parquet folders, appended to and folded when read.

A micro-batch is written once, as it came, into a folder of its own; nothing that is there is rewritten, however scattered the keys of the batch are. Reading
folds the batches onto the newest snapshot: one aggregate over the changes, one join with the snapshot by key. Exact re-deliveries change
nothing in a fold, and late rows take their place in the order of the log. A snapshot, taken every so many batches, bounds what a read folds.

Spark's own commit is all that is relied on: a folder counts once its ``_SUCCESS`` file is there. A batch that a failure cut short is written
again; one that was finished is skipped. Rows of paused devices, and rows behind a missing segment, are in the batches like
all others; reading leaves them out until the device is resumed or the segment has come. Which devices are paused, and since which
batch, is a small table of its own.

Batches of one table come from one writer, in ascending order. Use a lakehouse MERGE (``writers.merge_statement``) where readers cannot fold.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.functions.columns import join_same
from deltaloom.model import CHANGE_COLS, DEVICE_COLS, ROW_OPS, TableSpec
from deltaloom.operators.fold import merge, spread
from deltaloom.operators.normalize import after_marks, high_marks, hold_gaps
from deltaloom.storage import list_dir

_CHANGES = (
    "_device_id string, _device_name string, _segment bigint, _seq bigint, _txn_seq bigint, _commit_id bigint, _op string, _set_cols array<string>"
)
_MARKS = "_device_id string, _device_name string, _applied struct<_segment:bigint,_seq:bigint,_txn_seq:bigint>, _applied_commit bigint"
_PAUSES = "_device_id string, _paused boolean, _since bigint, event bigint"


@dataclass
class ChangeTable:
    spark: SparkSession
    root: str
    spec: TableSpec
    ops: tuple[str, ...] = ROW_OPS
    #: Number of every device's first segment; None if a device may send no rows for a segment, so that gaps mean nothing.
    first_segment: int | None = None

    # -- folders -----------------------------------------------------------------

    def _finished(self, kind: str, proof: str = "") -> list[str]:
        """Names of finished folders, in order."""
        return [n for n in list_dir(self.spark, f"{self.root}/{kind}") if "_SUCCESS" in list_dir(self.spark, f"{self.root}/{kind}/{n}{proof}")]

    def _read(self, schema: str, kind: str, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}")
        return reader.parquet(*[f"{self.root}/{kind}/{n}" for n in names])

    def _columns(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spec.schema.fields)

    def _snapshot(self) -> tuple[str | None, int]:
        """The newest snapshot, and the last batch in it."""
        done = self._finished("snapshots", "/state")
        return (done[-1], int(done[-1].split("-")[0]) - 1) if done else (None, -1)

    def last_batch(self) -> int:
        """Number of the last batch that is in the table; -1 if there is none."""
        return max([int(n.split("=")[1]) for n in self._finished("changes")], default=self._snapshot()[1])

    # -- writing -----------------------------------------------------------------

    def apply(self, changes: DataFrame, batch_id: int) -> bool:
        """One batch of changes. False when the batch was applied before."""
        name = f"batch={batch_id:012d}"
        if batch_id <= self._snapshot()[1] or name in self._finished("changes"):
            return False
        changes.select(*CHANGE_COLS, *self.spec.columns).write.mode("overwrite").parquet(f"{self.root}/changes/{name}")
        return True

    def pause(self, device_ids: Iterable[str]) -> None:
        """Leave out these devices' rows from the next batch on."""
        self._note(device_ids, True)

    def resume(self, device_ids: Iterable[str]) -> None:
        """Count these devices' rows again, those that waited included."""
        self._note(device_ids, False)

    def _note(self, device_ids: Iterable[str], paused: bool) -> None:
        number, since = len(list_dir(self.spark, f"{self.root}/pauses")), self.last_batch()
        noted = self.spark.createDataFrame([(d, paused, since) for d in device_ids], "_device_id string, _paused boolean, _since bigint")
        noted.coalesce(1).write.parquet(f"{self.root}/pauses/event={number:012d}")

    def snapshot(self) -> None:
        """Fold all batches so far into a new snapshot; later reads fold only what comes after it."""
        state, marks, waiting = self._parts()
        self.write_snapshot(state, marks, waiting)

    def write_snapshot(self, state: DataFrame, marks: DataFrame, waiting: DataFrame) -> None:
        """Replace the table as of its last batch by a state, what each device has applied, and the rows that wait. The state is written last."""
        name = f"{self.last_batch() + 1:012d}-{len(list_dir(self.spark, f'{self.root}/snapshots')):06d}"
        for part, frame in (("marks", marks), ("waiting", waiting), ("state", state)):
            frame.write.parquet(f"{self.root}/snapshots/{name}/{part}")

    # -- reading -----------------------------------------------------------------

    def read(self) -> DataFrame:
        """State frame of the table now."""
        return self._parts()[0]

    def marks(self) -> DataFrame:
        """Applied position and commit per device."""
        return self._parts()[1]

    def waiting(self) -> DataFrame:
        """Rows held back: of paused devices, and behind a missing segment. Their batch is in ``batch``."""
        return self._parts()[2]

    def paused(self) -> DataFrame:
        """Paused devices and the last batch before each was paused: ``_device_id, _since``."""
        events = self._read(_PAUSES, "pauses", self._finished("pauses"))
        last = events.groupBy("_device_id").agg(F.max(F.struct("event", "_paused", "_since")).alias("e"))
        return last.where("e._paused").select("_device_id", "e._since")

    def _parts(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """State, marks, and waiting rows."""
        snapshot, upto = self._snapshot()
        schema = f"{_CHANGES}, {self._columns()}, batch bigint"
        later = [n for n in self._finished("changes") if int(n.split("=")[1]) > upto]
        log = self._read(schema, "changes", later)
        state = self._read(f"_device_id string, _device_name string, _commit_id bigint, {self._columns()}", "snapshots", [f"{snapshot}/state"] if snapshot else [])
        marks = self._read(_MARKS, "snapshots", [f"{snapshot}/marks"] if snapshot else [])
        if snapshot:
            log = after_marks(log.unionByName(self._read(schema, "snapshots", [f"{snapshot}/waiting"])), marks)
        held = join_same(log, self.paused(), ["_device_id"], "left")
        waits = F.coalesce(F.col("batch") > F.col("_since"), F.lit(False))
        ready, waiting = held.where(~waits).drop("_since"), held.where(waits).drop("_since")
        if self.first_segment is not None:
            ready, behind = hold_gaps(ready, marks, self.first_segment)
            waiting = waiting.unionByName(behind)
        ready = ready.drop("batch")
        moved = marks.unionByName(high_marks(ready)).groupBy(*DEVICE_COLS)
        moved = moved.agg(F.max("_applied").alias("_applied"), F.max("_applied_commit").alias("_applied_commit"))
        return merge(state, spread(ready, self.spec), self.spec, self.ops), moved, waiting
