"""Streaming operators: each result must equal that of the batch fold."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from deltaloom.model import TableSpec
from deltaloom.operators.fold import tag_devices
from deltaloom.operators.normalize import expand_transaction_stream, hold_gaps
from deltaloom.sinks.changetable import ChangeTable
from deltaloom.sources import messages
from deltaloom.sources import segments as sg
from deltaloom.streaming import apply as st
from deltaloom.streaming import current
from deltaloom.storage import fresh_dir
from workload import Registry
from workload import closed_forms as cf
from workload.sources import PAYLOAD_SCHEMA

registry = Registry()
add = registry.add

DROPS = (range(2), range(4), range(6))


def drop_files(spark, sf, path, number):
    """Write drop ``number``: its new segments, and everything earlier again."""
    fx.orders_log(spark, sf, segments=DROPS[number]).write.parquet(f"{path}/drop={number}")


def wait(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def orders_table(spark, sf, label):
    return ChangeTable(spark, fresh_dir(spark, label), fx.orders_spec(spark, sf), fx.ORDERS_OPS)


@add("stream_apply", cf.orders_rows())
def stream_apply(spark, sf):
    """Three drops, each re-delivering all earlier rows; the query restarts in between."""
    log_path, table = fresh_dir(spark, "drops"), orders_table(spark, sf, "applied")
    schema = fx.orders_log(spark, sf).schema
    for number in range(len(DROPS)):
        drop_files(spark, sf, log_path, number)
        changes = st.read_change_files(spark, log_path, schema)
        wait(st.start_apply(changes, table, f"{table.root}-checkpoint", snapshot_every=2))
    return tag_devices(table.read(), table.spec.columns)


@add("replayed_batch", cf.orders_rows())
def replayed_batch(spark, sf):
    """A batch number seen before changes nothing, whatever it holds."""
    table = orders_table(spark, sf, "replayed")
    log = fx.orders_log(spark, sf)
    table.apply(log, 7)
    table.apply(log.withColumn("_segment", F.col("_segment") + 100), 7)
    table.apply(log, 8)
    return tag_devices(table.read(), table.spec.columns)


@add("stream_append", "SELECT event_id, event_type, value FROM events")
def stream_append(spark, sf):
    path, out = fresh_dir(spark, "events-in"), fresh_dir(spark, "events-out")
    events = fx.table(spark, sf, "events").select("event_id", "event_type", "value")
    events.write.parquet(f"{path}/a")
    stream = st.read_change_files(spark, path, events.schema)
    wait(st.start_append(stream, out, f"{out}-checkpoint", partition_by=("event_type",)))
    return spark.read.parquet(out).select("event_id", "event_type", "value")


@add("change_log_roll", "SELECT count(*) AS n_rows, TRUE AS rolled FROM orders")
def change_log_roll(spark, sf):
    """Change-log files never hold more than the agreed number of rows."""
    path, out = fresh_dir(spark, "roll-in"), fresh_dir(spark, "roll-out")
    log = fx.orders_log(spark, sf, redelivered=False, segments=range(1))
    log.write.parquet(f"{path}/a")
    stream = st.read_change_files(spark, path, log.schema)
    wait(st.start_change_log(stream, out, f"{out}-checkpoint", records=1000, seconds=None))
    per_file = spark.read.parquet(out).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 1000).alias("rolled"))


@add("pause_resume", cf.orders_rows())
def pause_resume(spark, sf):
    """dev-3 is paused for two of three drops, then its backlog drains in order."""
    table = orders_table(spark, sf, "pausable")
    table.pause(["dev-3"])
    for number, parts in enumerate(DROPS):
        if number == 2:
            table.resume(["dev-3"])
        table.apply(fx.orders_log(spark, sf, segments=parts), number)
    return tag_devices(table.read(), table.spec.columns)


@add("paused_state", cf.orders_rows(where=f"{cf.ALIVE} AND o_custkey % 4 <> 3"))
def paused_state(spark, sf):
    """While dev-3 is paused none of its rows arrive; the others are complete."""
    table = orders_table(spark, sf, "paused")
    table.pause(["dev-3"])
    table.apply(fx.orders_log(spark, sf), 0)
    return tag_devices(table.read(), table.spec.columns)


@add("resume_before_drain", cf.orders_rows())
def resume_before_drain(spark, sf):
    """dev-3 is resumed, then live rows arrive: they are folded together with what waited."""
    table = orders_table(spark, sf, "resumed")
    table.pause(["dev-3"])
    table.apply(fx.orders_log(spark, sf, segments=range(3)), 0)
    table.resume(["dev-3"])
    table.apply(fx.orders_log(spark, sf, segments=range(3, 6)), 1)
    return tag_devices(table.read(), table.spec.columns)


@add("resume_same_batch_number", cf.orders_rows())
def resume_same_batch_number(spark, sf):
    """Resuming between batches 0 and 1 takes no batch number, so the stream's batch 1 is not skipped."""
    table = orders_table(spark, sf, "drained")
    log = fx.orders_log(spark, sf)
    table.pause(["dev-3", "dev-0"])
    table.apply(log.where(F.col("_segment") < 2), 0)
    table.resume(["dev-3"])
    table.resume(["dev-0"])
    table.apply(log.where(F.col("_segment") >= 2), 1)
    return tag_devices(table.read(), table.spec.columns)


EARLY_ROWS = cf.orders_rows(
    status="CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END", priority="o_orderpriority", where="o_orderkey % 7 <> 0", stamp=None
)


def late_segments(spark, sf, label, order):
    """The stream restarts for every segment; the table waits for the ones in between."""
    log_path, table = fresh_dir(spark, "drops"), orders_table(spark, sf, label)
    table.first_segment = 0
    schema = fx.orders_log(spark, sf).schema
    for segment in order:
        fx.orders_log(spark, sf, segments=range(segment, segment + 1)).write.parquet(f"{log_path}/drop={segment}")
        wait(st.start_apply(st.read_change_files(spark, log_path, schema), table, f"{table.root}-checkpoint"))
    return tag_devices(table.read(), table.spec.columns).drop("sys_update_ts")


@add("stream_late_segment", EARLY_ROWS)
def stream_late_segment(spark, sf):
    """Segments 0, 2, 1: the inserts, the deletes, and the updates that came too late."""
    return late_segments(spark, sf, "late", (0, 2, 1))


@add("stream_first_segment_late", EARLY_ROWS)
def stream_first_segment_late(spark, sf):
    """Segments 1, 2, 0: nothing is applied before the inserts are there."""
    return late_segments(spark, sf, "first-late", (1, 2, 0))


@add(
    "reinit_device",
    f"SELECT {cf.DEVICE} AS device_id, o_orderkey, CASE WHEN o_custkey % 4 = 1 THEN o_orderstatus ELSE {cf.STATUS} END "
    f"AS o_orderstatus FROM orders WHERE o_custkey % 4 = 1 OR {cf.ALIVE}",
)
def reinit_device(spark, sf):
    """dev-1 is re-initialised with a clean (replicated) destination and loads segment 0 again."""
    table = orders_table(spark, sf, "reinit")
    table.apply(fx.orders_log(spark, sf), 0)
    st.reinitialise(table, "dev-1", clean=True, shared=False)
    again = fx.orders_log(spark, sf, segments=range(1))
    table.apply(again, 1)
    return table.read().select(F.col("_device_id").alias("device_id"), "o_orderkey", "o_orderstatus")


@add(
    "gap_hold",
    f"WITH {cf.orders_log(False)} SELECT CASE WHEN device_id = 'dev-2' AND segment > 2 THEN 'held' ELSE 'ready' END AS verdict, "
    "device_id, count(*) AS n FROM log WHERE NOT (device_id = 'dev-2' AND segment = 2) GROUP BY 1, 2",
)
def gap_hold(spark, sf):
    """Segment 2 of dev-2 is missing: what follows it waits."""
    log = fx.orders_log(spark, sf, redelivered=False)
    log = log.where(~((F.col("_device_id") == "dev-2") & (F.col("_segment") == 2)))
    no_marks = fx.orders_marks(spark, sf).where(F.lit(False))
    ready, held = hold_gaps(log, no_marks)
    both = ready.select(F.lit("ready").alias("verdict"), "_device_id").unionByName(
        held.select(F.lit("held").alias("verdict"), "_device_id")
    )
    return both.groupBy("verdict", F.col("_device_id").alias("device_id")).agg(F.count("*").alias("n"))


@add(
    "stream_fan_out",
    f"SELECT 'shared' AS destination, count(*) AS n FROM orders WHERE {cf.ALIVE} UNION ALL "
    f"SELECT 'dev-0', count(*) FROM orders WHERE {cf.ALIVE} AND o_custkey % 4 = 0 UNION ALL "
    f"SELECT 'log', count(*) FROM (WITH {cf.orders_log()} SELECT * FROM log)",
)
def stream_fan_out(spark, sf):
    """One stream to a shared table, a single device's table, and a plain log."""
    path = fresh_dir(spark, "fan-in")
    drop_files(spark, sf, path, 2)
    stream = st.read_change_files(spark, path, fx.orders_log(spark, sf).schema)
    shared, single = orders_table(spark, sf, "shared"), orders_table(spark, sf, "single")
    raw = fresh_dir(spark, "raw")
    targets = [
        st.FanOutTarget("shared", lambda batch, n: shared.apply(batch, n)),
        st.FanOutTarget("dev-0", lambda batch, n: single.apply(batch.where("_device_id = 'dev-0'"), n)),
        st.FanOutTarget("log", lambda batch, n: batch.write.mode("overwrite").parquet(f"{raw}/batch={n}")),
    ]
    wait(st.start_fan_out(stream, targets, f"{raw}-checkpoint"))
    parts = {"shared": shared.read(), "dev-0": single.read(), "log": spark.read.parquet(raw)}
    counted = None
    for name, df in parts.items():
        one = df.agg(F.lit(name).alias("destination"), F.count("*").alias("n"))
        counted = one if counted is None else counted.unionByName(one)
    return counted


@add(
    "stream_iot",
    "SELECT 'site/' || (user_id % 3) || '/' || event_type AS topic, event_id AS id, user_id AS \"user\", value AS reading "
    "FROM events WHERE event_id % 50 <> 0",
)
def stream_iot(spark, sf):
    """Messages parsed on the stream and appended."""
    path, out = fresh_dir(spark, "iot-in"), fresh_dir(spark, "iot-out")
    inbox = fx.messages(spark, sf).select("topic", "payload")
    inbox.write.parquet(f"{path}/a")
    stream = st.read_change_files(spark, path, inbox.schema)
    rows = messages.accepted(messages.parse_payload(stream, PAYLOAD_SCHEMA, ";"), "topic")
    wait(st.start_append(rows, out, f"{out}-checkpoint"))
    return spark.read.parquet(out)


@add(
    "stream_segments",
    f"WITH {cf.orders_log(False)} SELECT device_id, segment, count(*) AS n FROM log GROUP BY 1, 2",
)
def stream_segments(spark, sf):
    """Segment files discovered as a stream; offsets are kept per device. dev-3's control rows meet its transaction files, a stream of their own."""
    stage, out = fx.stage_segments(spark, sf, fresh_dir(spark, "stage"), dense=True), fresh_dir(spark, "segments-out")
    log = sg.scan_log(spark, stage, fx.STAGE_PATTERN, streaming=True)
    log = expand_transaction_stream(log, sg.scan_transactions(spark, stage, fx.STAGE_PATTERN, streaming=True))
    wait(st.start_append(log, out, f"{out}-checkpoint"))
    rows = spark.read.parquet(out).where(~F.col("sql").startswith("CREATE"))
    # the original segment is part of the commit time
    segment = F.floor((F.col("_commit_id") - fx.EPOCH) / fx.STEP)
    return rows.groupBy(F.col("_device_id").alias("device_id"), segment.alias("segment")).agg(F.count("*").alias("n"))


@add(
    "stream_current_rows",
    f"SELECT {cf.DEVICE} AS device_id, o_orderkey, {cf.STATUS} AS o_orderstatus, {cf.PRIORITY} AS o_orderpriority "
    f"FROM orders WHERE {cf.ALIVE}",
)
def stream_current_rows(spark, sf):
    """Compacted log -> state per key -> changed rows; the last row per key is the table."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", current.ROCKSDB)
    narrow = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    log = fx.orders_log(spark, sf).select(*[c for c in fx.orders_log(spark, sf).columns if c.startswith("_")], *narrow)
    spec = TableSpec.of("orders", log, "o_orderkey")
    path, short, out = (fresh_dir(spark, n) for n in ("raw-log", "short-log", "current"))
    for number in (0, 2):
        part = log.where(F.col("_segment") < 3) if number == 0 else log.where(F.col("_segment") >= 3)
        part.write.parquet(f"{path}/drop={number}")
        raw = st.read_change_files(spark, path, log.schema)
        wait(st.start_compaction(raw, spec, short, f"{short}-checkpoint", fx.ORDERS_OPS))
    changes = st.read_change_files(spark, short, log.schema)
    rows = current.current_rows(changes, spec, fx.ORDERS_OPS)

    def save(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = rows.writeStream.foreachBatch(save).outputMode("update").option("checkpointLocation", f"{out}-checkpoint")
    wait(query.trigger(availableNow=True).start())
    emitted = spark.read.parquet(out)
    last = emitted.groupBy("_device_id", "o_orderkey").agg(
        F.max_by(F.struct("_live", "o_orderstatus", "o_orderpriority"), F.struct("batch", "_commit_id")).alias("r")
    )
    return last.where("r._live").select(F.col("_device_id").alias("device_id"), "o_orderkey", "r.o_orderstatus", "r.o_orderpriority")

