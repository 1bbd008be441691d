"""Sync statistics, latency, status, per-table counts, fleet view, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.functions.columns import join_same
from deltaloom.model import DEVICE_COLS, ROW_OPS, commit_time
from deltaloom.operators.normalize import after_marks


def sync_statistics(changes: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """What each device's log holds.

    Distinct counts go through two plain aggregates instead of a count-distinct
    expansion: first per (device, segment, commit), then per device.
    ``sizes`` optionally gives ``_device_id, _segment, size_bytes``.
    """
    commits = changes.groupBy(*DEVICE_COLS, "_segment", "_commit_id").agg(F.count("*").alias("_n"))
    per_commit = commits.groupBy(*DEVICE_COLS, "_commit_id").agg(F.sum("_n").alias("_n"))
    txns = per_commit.groupBy(*DEVICE_COLS).agg(
        F.sum("_n").alias("oper_count"),
        F.count("*").alias("txn_count"),
        F.max("_commit_id").alias("last_commit_id"),
    )
    segments = (
        commits.groupBy(*DEVICE_COLS, "_segment")
        .agg(F.lit(1).alias("_one"))
        .groupBy(*DEVICE_COLS)
        .agg(F.count("*").alias("segment_count"))
    )
    stats = join_same(txns, segments, DEVICE_COLS)
    if sizes is not None:
        bytes_ = sizes.groupBy("_device_id").agg(F.sum("size_bytes").alias("log_size"))
        stats = join_same(stats, bytes_, ["_device_id"], "left")
    return stats


def sync_latency(captured: DataFrame, marks: DataFrame) -> DataFrame:
    """Newest commit at the source minus newest applied one, in ms; -1 = unknown."""
    source = captured.groupBy(*DEVICE_COLS).agg(F.max("_commit_id").alias("source_commit_id"))
    applied = marks.select(*DEVICE_COLS, F.col("_applied_commit").alias("applied_commit_id"))
    gap = F.col("source_commit_id") - F.col("applied_commit_id")
    return join_same(source, applied, DEVICE_COLS, "left").withColumn("latency_ms", F.coalesce(gap, F.lit(-1)))


def sync_status(devices: DataFrame, marks: DataFrame, paused: DataFrame) -> DataFrame:
    """NotInitialized / Paused / Running, and when the device was last heard of."""
    known = devices.select(*DEVICE_COLS).distinct()
    applied = marks.select(*DEVICE_COLS, F.col("_applied_commit"))
    held = paused.select("_device_id", F.lit(True).alias("_paused")).distinct()
    state = (
        F.when(F.col("_applied_commit").isNull(), "NotInitialized")
        .when(F.col("_paused"), "Paused")
        .otherwise("Running")
    )
    told = join_same(join_same(known, applied, DEVICE_COLS, "left"), held, ["_device_id"], "left")
    return told.select(*DEVICE_COLS, state.alias("state"), commit_time(F.col("_applied_commit")).alias("heartbeat"))


def table_statistics(changes: DataFrame, table: Column | str = "_table") -> DataFrame:
    """Changes per device, table and operation."""
    name = F.col(table) if isinstance(table, str) else table
    counts = [F.count_if(F.col("_op") == op).alias(op.lower()) for op in ROW_OPS]
    return changes.groupBy(*DEVICE_COLS, name.alias("table_name")).agg(*counts)


def fleet_dashboard(changes: DataFrame, marks: DataFrame, paused: DataFrame) -> DataFrame:
    """One row for the fleet: devices by state, total operations, worst lag."""
    status = sync_status(changes, marks, paused)
    latency = sync_latency(changes, marks)
    counts = changes.groupBy(*DEVICE_COLS).agg(F.count("*").alias("_n"))
    per_device = join_same(join_same(status, latency, DEVICE_COLS), counts, DEVICE_COLS)
    return per_device.agg(
        F.count("*").alias("devices"),
        F.count_if(F.col("state") == "Running").alias("running"),
        F.count_if(F.col("state") == "Paused").alias("paused"),
        F.count_if(F.col("state") == "NotInitialized").alias("not_initialized"),
        F.sum("_n").alias("oper_count"),
        F.max("latency_ms").alias("max_latency_ms"),
    )


def throughput(changes: DataFrame, width: str = "1 minute") -> DataFrame:
    """Operations per device and time bucket of their commit."""
    bucket = F.window(commit_time(F.col("_commit_id")), width)
    return (
        changes.groupBy(*DEVICE_COLS, bucket.alias("_w"))
        .agg(F.count("*").alias("oper_count"))
        .select(*DEVICE_COLS, F.col("_w")["start"].alias("bucket"), "oper_count")
    )


def lag_alerts(latency: DataFrame, threshold_ms: int) -> DataFrame:
    """Devices over the threshold; a device that never synced counts as over."""
    return latency.where((F.col("latency_ms") > threshold_ms) | (F.col("latency_ms") < 0))


def backlog(changes: DataFrame, marks: DataFrame) -> DataFrame:
    """Changes still to be applied, per device."""
    return after_marks(changes, marks).groupBy(*DEVICE_COLS).agg(F.count("*").alias("pending"))
