"""Change streams applied to tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deltaloom.model import INSERT, ROW_OPS, TableSpec, order_of
from deltaloom.operators.fold import compact, spread
from deltaloom.sinks.changetable import ChangeTable


def read_change_files(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet change-log files below a folder, as a stream."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _trigger(writer, seconds: int | None):
    return writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")


def start_apply(
    stream: DataFrame,
    table: ChangeTable,
    checkpoint: str,
    every_seconds: int | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    snapshot_every: int | None = 64,
) -> StreamingQuery:
    """Add each micro-batch to the table, exactly once.

    A batch is a folder of the table with the batch's number, so one that Spark replays after a restart is skipped if it was finished and written
    again if not. Rows of paused devices, and rows behind a missing segment if the table states its first segment, wait in the table
    (R04, R07). ``prepare`` can filter or map a batch first. Every ``snapshot_every`` batches the table is folded into a snapshot.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch if prepare is None else prepare(batch), batch_id)
        if snapshot_every and (batch_id + 1) % snapshot_every == 0:
            table.snapshot()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _trigger(writer, every_seconds).start()


@dataclass(frozen=True)
class FanOutTarget:
    """One destination of a stream with its own mode and progress."""

    name: str
    apply: Callable[[DataFrame, int], None]


def start_fan_out(
    stream: DataFrame, targets: list[FanOutTarget], checkpoint: str, every_seconds: int | None = None
) -> StreamingQuery:
    """One stream, several destinations. The batch is read once.

    Each destination must skip batch numbers it has seen (a ChangeTable
    does): after a failure in one, Spark replays the batch to all of them.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for target in targets:
                target.apply(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _trigger(writer, every_seconds).start()


def start_append(
    stream: DataFrame, path: str, checkpoint: str, every_seconds: int | None = None, partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Append-only stream to Parquet; read it back with merged schemas.

    A new column means a restart with a wider stream schema; files written
    before simply lack it.
    """
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer.outputMode("append"), every_seconds).start()


# Default thresholds at which a log file rolls
ROLL_RECORDS, ROLL_SECONDS = 1_000_000, 5


def start_change_log(
    stream: DataFrame, path: str, checkpoint: str, records: int = ROLL_RECORDS, seconds: int | None = ROLL_SECONDS
) -> StreamingQuery:
    """Change-log files that roll by record count and by time."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("maxRecordsPerFile", records)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, seconds).start()


def start_compaction(
    stream: DataFrame, spec: TableSpec, path: str, checkpoint: str, ops: Iterable[str] = ROW_OPS, every_seconds: int | None = None
) -> StreamingQuery:
    """A09 on a stream: change-log files with at most two rows per key and batch.

    Feed these to operators that visit a key's changes one by one, such as
    :mod:`deltaloom.streaming.current`. A replayed batch overwrites its folder.
    """
    ops = tuple(ops)

    def apply(batch: DataFrame, batch_id: int) -> None:
        compact(spread(batch, spec), spec, ops).write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _trigger(writer, every_seconds).start()


def reinitialise(table: ChangeTable, device_id: str, clean: bool, shared: bool, seed: DataFrame | None = None) -> None:
    """Forget a device's progress and what waited of it, optionally its rows, and re-seed it.

    In a shared (consolidated) table ``clean`` is a no-op. ``seed`` is a state
    frame with the device's current snapshot.
    """
    others = ~F.col("_device_id").eqNullSafe(F.lit(device_id))
    state = table.read()
    if (clean and not shared) or seed is not None:
        state = state.where(others)
    if seed is not None:
        state = state.unionByName(seed)
    table.write_snapshot(state, table.marks().where(others), table.waiting().where(others))


def appended_only(stream: DataFrame) -> DataFrame:
    """T06 on a stream: what an append-only device may send."""
    return stream.where(F.col("_op") == INSERT)


def observed(stream: DataFrame, name: str) -> DataFrame:
    """A15 on a stream: operation counts as query metrics, without another pass."""
    counts = [F.count_if(F.col("_op") == op).alias(op.lower()) for op in ROW_OPS]
    return stream.observe(name, F.count("*").alias("changes"), F.max(order_of()["_segment"]).alias("segment"), *counts)
