"""Monitoring, validation and query shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from deltaloom.functions.columns import join_same
from deltaloom.operators import evolve
from deltaloom.operators import monitor as mon
from deltaloom.operators import query as q
from deltaloom.operators import validate as val
from deltaloom.plans.replay import consolidate, replica_of, replicate
from workload import Registry
from workload import closed_forms as cf

registry = Registry()
add = registry.add


def device(df):
    names = {"_device_id": "device_id", "_device_name": "device_name"}
    return df.withColumnsRenamed(names)


def paused(spark, sf):
    return fx.orders_devices(spark, sf).where(F.col("_device_id") == "dev-0")


LOG = cf.orders_log(False)


@add(
    "sync_statistics",
    f"WITH {LOG} SELECT device_id, device_name, count(*) AS oper_count, count(DISTINCT commit_id) AS txn_count, "
    "max(commit_id) AS last_commit_id, count(DISTINCT segment) AS segment_count, "
    "sum(100 + segment)::BIGINT AS log_size FROM log GROUP BY 1, 2",
)
def sync_statistics(spark, sf):
    log = fx.orders_log(spark, sf, redelivered=False)
    sizes = log.select("_device_id", "_segment", (F.col("_segment") + 100).alias("size_bytes"))
    return device(mon.sync_statistics(log, sizes))


LATENCY = (
    "latency AS (SELECT device_id, device_name, max(log.commit_id) AS source_commit_id, "
    "any_value(marks.commit_id) AS applied_commit_id, "
    "coalesce(max(log.commit_id) - any_value(marks.commit_id), -1) AS latency_ms "
    "FROM log LEFT JOIN marks USING (device_id, device_name) GROUP BY 1, 2)"
)
STATUS = (
    "status AS (SELECT device_id, device_name, CASE WHEN applied_commit_id IS NULL THEN 'NotInitialized' "
    f"WHEN device_id = 'dev-0' THEN 'Paused' ELSE 'Running' END AS state, {cf.at('applied_commit_id')} AS heartbeat FROM latency)"
)


@add("sync_latency", f"WITH {LOG}, {cf.MARKS}, {LATENCY} SELECT * FROM latency")
def sync_latency(spark, sf):
    return device(mon.sync_latency(fx.orders_log(spark, sf, redelivered=False), fx.orders_marks(spark, sf)))


def unnamed(df):
    """The frame as if dev-1, which has been applied in part, had no name."""
    return df.withColumn("_device_name", F.when(F.col("_device_id") != "dev-1", F.col("_device_name")))


#: SQL of the same: devices are joined by id.
UNNAMED = "CASE WHEN device_id <> 'dev-1' THEN device_name END AS device_name"


@add("latency_null_names", f"WITH {LOG}, {cf.MARKS}, {LATENCY} SELECT * REPLACE ({UNNAMED}) FROM latency")
def latency_null_names(spark, sf):
    log, marks = unnamed(fx.orders_log(spark, sf, redelivered=False)), unnamed(fx.orders_marks(spark, sf))
    return device(mon.sync_latency(log, marks))


@add(
    "status_null_names",
    f"WITH {LOG}, {cf.MARKS}, {LATENCY}, {STATUS} SELECT s.device_id, CASE WHEN s.device_id <> 'dev-1' THEN s.device_name END AS device_name, s.state, heartbeat, "
    "count(*) AS oper_count, count(DISTINCT log.commit_id) AS txn_count FROM status s JOIN log USING (device_id) GROUP BY ALL",
)
def status_null_names(spark, sf):
    """Status and statistics of devices, one without a name."""
    log, marks = unnamed(fx.orders_log(spark, sf, redelivered=False)), unnamed(fx.orders_marks(spark, sf))
    status = mon.sync_status(unnamed(fx.orders_devices(spark, sf)), marks, paused(spark, sf))
    stats = mon.sync_statistics(log).select("_device_id", "_device_name", "oper_count", "txn_count")
    return device(join_same(status, stats, ["_device_id", "_device_name"]))


@add("sync_status", f"WITH {LOG}, {cf.MARKS}, {LATENCY}, {STATUS} SELECT * FROM status")
def sync_status(spark, sf):
    """dev-0 is paused, dev-1 runs, the others never synced."""
    return device(mon.sync_status(fx.orders_devices(spark, sf), fx.orders_marks(spark, sf), paused(spark, sf)))


@add(
    "table_statistics",
    f"WITH {LOG} SELECT device_id, device_name, 'orders' AS table_name, count(*) FILTER (op = 'INSERT') AS \"insert\", "
    "count(*) FILTER (op = 'UPDATE') AS \"update\", count(*) FILTER (op = 'DELETE') AS \"delete\", "
    "0::BIGINT AS upsert, 0::BIGINT AS replace FROM log GROUP BY 1, 2",
)
def table_statistics(spark, sf):
    log = fx.orders_log(spark, sf, redelivered=False)
    return device(mon.table_statistics(log, F.lit("orders")))


FLEET = (
    f"WITH {LOG}, {cf.MARKS}, {LATENCY}, {STATUS} SELECT count(*) AS devices, count(*) FILTER (state = 'Running') AS running, "
    "count(*) FILTER (state = 'Paused') AS paused, count(*) FILTER (state = 'NotInitialized') AS not_initialized, "
    "(SELECT count(*) FROM log) AS oper_count, (SELECT max(latency_ms) FROM latency) AS max_latency_ms FROM status"
)


@add("fleet_dashboard", FLEET)
def fleet_dashboard(spark, sf):
    return mon.fleet_dashboard(
        fx.orders_log(spark, sf, redelivered=False), fx.orders_marks(spark, sf), paused(spark, sf)
    )


@add("fleet_null_names", FLEET)
def fleet_null_names(spark, sf):
    """A device without a name counts like any other."""
    log, marks = unnamed(fx.orders_log(spark, sf, redelivered=False)), unnamed(fx.orders_marks(spark, sf))
    return mon.fleet_dashboard(log, marks, paused(spark, sf))


@add(
    "throughput",
    f"WITH {LOG} SELECT device_id, device_name, time_bucket(INTERVAL 1 MINUTE, {cf.at('commit_id')}) AS bucket, "
    "count(*) AS oper_count FROM log GROUP BY 1, 2, 3",
)
def throughput(spark, sf):
    return device(mon.throughput(fx.orders_log(spark, sf, redelivered=False)))


@add("lag_alerts", f"WITH {LOG}, {cf.MARKS}, {LATENCY} SELECT * FROM latency WHERE latency_ms > 3000000000 OR latency_ms < 0")
def lag_alerts(spark, sf):
    latency = mon.sync_latency(fx.orders_log(spark, sf, redelivered=False), fx.orders_marks(spark, sf))
    return device(mon.lag_alerts(latency, 3_000_000_000))


@add(
    "pending_backlog",
    f"WITH {cf.orders_log()}, {cf.MARKS} SELECT log.device_id, log.device_name, count(*) AS pending FROM log "
    "LEFT JOIN marks USING (device_id) WHERE marks.segment IS NULL OR log.segment > marks.segment GROUP BY 1, 2",
)
def pending_backlog(spark, sf):
    return device(mon.backlog(fx.orders_log(spark, sf), fx.orders_marks(spark, sf)))


# -- validation ------------------------------------------------------------------------------

KINDS = (
    "SELECT o_orderkey, 'missing' AS kind FROM orders WHERE o_orderkey % 13 = 0 UNION ALL "
    "SELECT o_orderkey + 10000000000, 'extra' FROM orders WHERE o_orderkey % 19 = 0 UNION ALL "
    "SELECT o_orderkey, 'mismatched' FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey % 13 <> 0"
)


@add("diff_rows", KINDS)
def diff_rows(spark, sf):
    source, dest = fx.diff_pair(spark, sf)
    return val.compare_rows(source, dest, ["o_orderkey"])


@add(
    "diff_report",
    f"SELECT d.o_orderkey, kind, CASE WHEN kind = 'mismatched' THEN 'o_orderstatus' END AS column_name, "
    "CASE WHEN kind = 'mismatched' THEN o_orderstatus END AS source_value, "
    f"CASE WHEN kind = 'mismatched' THEN 'Q' END AS dest_value FROM ({KINDS}) d LEFT JOIN orders o ON d.o_orderkey = o.o_orderkey",
)
def diff_report(spark, sf):
    source, dest = fx.diff_pair(spark, sf)
    return val.difference_report(source, dest, ["o_orderkey"])


@add("diff_by_buckets", KINDS)
def diff_by_buckets(spark, sf):
    """The same differences; rows in buckets with equal checksums never meet."""
    source, dest = fx.diff_pair(spark, sf)
    return val.compare_by_buckets(source, dest, ["o_orderkey"])


@add("diff_null_keys", f"SELECT nullif(o_orderkey, 17) AS o_orderkey, kind FROM ({KINDS})")
def diff_null_keys(spark, sf):
    """A row whose key is null is found on the other side; it differs in its status only."""
    source, dest = (df.withColumn("o_orderkey", F.expr("nullif(o_orderkey, 17)")) for df in fx.diff_pair(spark, sf))
    return val.compare_rows(source, dest, ["o_orderkey"])


@add(
    "diff_report_null_keys",
    f"SELECT nullif(d.o_orderkey, 17) AS o_orderkey, kind, CASE WHEN kind = 'mismatched' THEN 'o_orderstatus' END AS column_name, "
    "CASE WHEN kind = 'mismatched' THEN o_orderstatus END AS source_value, "
    f"CASE WHEN kind = 'mismatched' THEN 'Q' END AS dest_value FROM ({KINDS}) d LEFT JOIN orders o ON d.o_orderkey = o.o_orderkey",
)
def diff_report_null_keys(spark, sf):
    source, dest = (df.withColumn("o_orderkey", F.expr("nullif(o_orderkey, 17)")) for df in fx.diff_pair(spark, sf))
    return val.difference_report(source, dest, ["o_orderkey"])


LINE = "l_orderkey, l_partkey, l_quantity, l_returnflag"


@add(
    "diff_bags",
    f"SELECT {LINE}, count(*) AS n_source, count(*) FILTER (l_linenumber <> 3) AS n_dest FROM lineitem GROUP BY ALL "
    "HAVING count(*) FILTER (l_linenumber = 3) > 0",
)
def diff_bags(spark, sf):
    """lineitem has no key: rows are compared with their number of copies."""
    lines = fx.table(spark, sf, "lineitem")
    columns = LINE.split(", ")
    return val.compare_bags(lines.select(*columns), lines.where(F.col("l_linenumber") != 3).select(*columns)).select(
        *columns, F.col("n_source").cast("bigint"), F.col("n_dest").cast("bigint")
    )


@add(
    "schema_diff",
    "SELECT 'events' AS table_name, 'props' AS column_name, 'string' AS source_type, NULL AS dest_type, 'missing' AS kind "
    "UNION ALL SELECT DISTINCT 'events', unnest(json_keys(props)), NULL, 'string', 'extra' FROM events",
)
def schema_diff(spark, sf):
    """The destination has grown one column per JSON field found in the data."""
    events = fx.table(spark, sf, "events")
    grown = evolve.add_json_columns(events, "props")
    return val.compare_schemas(q.catalog_columns(spark, {"events": events}), q.catalog_columns(spark, {"events": grown}))


@add(
    "txn_integrity",
    f"WITH {LOG} SELECT device_id, commit_id, kind FROM (SELECT device_id, commit_id, CASE "
    "WHEN segment = 1 AND o_orderkey % 97 = 0 AND o_orderkey % 3 <> 0 THEN 'rolled_back_change_applied' "
    "WHEN NOT (segment = 1 AND o_orderkey % 97 = 0) AND o_orderkey % 3 = 0 THEN 'missing_change' END AS kind FROM log) "
    "WHERE kind IS NOT NULL",
)
def txn_integrity(spark, sf):
    """Applied: all captured changes but those of every third key, committed or not."""
    captured = fx.orders_log(spark, sf)
    applied = captured.where(F.col("o_orderkey") % 3 != 0)
    found = val.transaction_integrity(captured, applied, fx.orders_commits(spark, sf))
    return found.select(F.col("_device_id").alias("device_id"), F.col("_commit_id").alias("commit_id"), "kind")


_WRITTEN = " || '|' || ".join(
    f"coalesce('=' || {text}, '~')"
    for text in (
        "o_custkey::VARCHAR", "epoch_us(o_orderdate)::VARCHAR", "o_orderkey::VARCHAR", "o_orderpriority", "o_orderstatus",
        "round(o_totalprice * 10000)::BIGINT::VARCHAR",
    )
)


@add("fingerprint", f"SELECT count(*) AS row_count, sum(('0x' || md5({_WRITTEN})[1:13])::BIGINT)::VARCHAR AS checksum FROM orders")
def fingerprint(spark, sf):
    """Row count and checksum of orders; equal for any row and column order."""
    return val.fingerprint(fx.table(spark, sf, "orders")).withColumn("checksum", F.col("checksum").cast("string"))


@add(
    "fingerprint_match",
    "SELECT count(*) AS row_count, TRUE AS same, FALSE AS changed_same FROM orders",
)
def fingerprint_match(spark, sf):
    """Orders against itself reordered, where the checksums must agree, and against a copy with one status changed."""
    orders = fx.table(spark, sf, "orders")
    a = val.fingerprint(orders)
    b = val.fingerprint(orders.select(*reversed(orders.columns)).repartition(7, "o_custkey"))
    first = F.col("o_orderkey") == orders.agg(F.min("o_orderkey")).scalar()
    c = val.fingerprint(orders.withColumn("o_orderstatus", F.when(first, "changed").otherwise(F.col("o_orderstatus"))))
    return a.select(
        "row_count",
        F.col("checksum").eqNullSafe(b.select("checksum").scalar()).alias("same"),
        F.col("checksum").eqNullSafe(c.select("checksum").scalar()).alias("changed_same"),
    )


# -- query shapes ---------------------------------------------------------------------------------


@add("param_query", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000")
def param_query(spark, sf):
    text = "SELECT o_orderkey, o_totalprice FROM q_orders WHERE o_orderstatus = ? AND o_totalprice > ?"
    return q.run_sql(spark, text, ["F", 250000.0], q_orders=fx.table(spark, sf, "orders"))


@add("top_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_orders(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return q.top_rows(orders, 20, F.desc("o_totalprice"), "o_orderkey")


@add(
    "table_counts",
    "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem "
    "UNION ALL SELECT 'events', count(*) FROM events",
)
def table_counts(spark, sf):
    return q.count_tables({name: fx.table(spark, sf, name) for name in ("orders", "lineitem", "events")})


@add(
    "join_orders_customer",
    f"SELECT c_mktsegment, o_orderpriority, count(*) AS n, {cf.total('o_totalprice')} AS revenue FROM orders "
    "JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
)
def join_orders_customer(spark, sf):
    joined = fx.table(spark, sf, "orders").join(
        fx.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.groupBy("c_mktsegment", "o_orderpriority").agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue")
    )


@add(
    "customers_without_orders",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
)
def customers_without_orders(spark, sf):
    big = fx.table(spark, sf, "orders").where(F.col("o_totalprice") > 300000)
    return (
        fx.table(spark, sf, "customer")
        .join(big, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
        .select("c_custkey")
    )


@add(
    "cross_device_totals",
    f"WITH t AS ({cf.orders_rows()}) SELECT sys_device_name, count(*) AS n_rows, {cf.total('o_totalprice')} AS total "
    "FROM t GROUP BY ROLLUP (sys_device_name)",
)
def cross_device_totals(spark, sf):
    table = consolidate(fx.orders_log(spark, sf), fx.orders_spec(spark, sf), fx.ORDERS_OPS)
    exact = table.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return q.totals_by_device(exact, "o_totalprice").withColumn("total", F.col("total").cast("double"))


@add(
    "device_union",
    f"SELECT {cf.DEVICE} AS device, count(*) AS n, count(note) AS notes FROM (SELECT *, "
    "CASE WHEN o_custkey % 4 = 1 THEN 'x' END AS note FROM orders) WHERE "
    f"{cf.ALIVE} GROUP BY 1",
)
def device_union(spark, sf):
    """The per-device tables of the replication layout, one with a column more."""
    copies = replicate(fx.orders_log(spark, sf), fx.orders_spec(spark, sf), fx.ORDERS_OPS)
    tables = {f"dev-{n}": replica_of(copies, f"dev-{n}") for n in range(4)}
    tables["dev-1"] = tables["dev-1"].withColumn("note", F.lit("x"))
    return q.union_devices(tables).groupBy("device").agg(F.count("*").alias("n"), F.count("note").alias("notes"))


@add(
    "rows_as_json",
    "SELECT c_custkey, to_json(struct_pack(c_custkey := c_custkey, c_name := c_name, c_mktsegment := c_mktsegment))::VARCHAR "
    "AS row_json FROM customer",
)
def rows_as_json(spark, sf):
    return q.rows_as_json(fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_custkey")


@add(
    "rows_as_arrays",
    "SELECT c_custkey, c_custkey::VARCHAR || '|' || c_name || '|' || c_nationkey::VARCHAR AS joined FROM customer",
)
def rows_as_arrays(spark, sf):
    rows = q.rows_as_arrays(fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), "c_custkey")
    return rows.select("c_custkey", F.array_join("row_values", "|").alias("joined"))


@add(
    "page_orders",
    "SELECT o_orderkey, o_totalprice, (SELECT count(*) > 100 FROM orders WHERE o_orderkey > 1000) AS has_more FROM orders "
    "WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 100",
)
def page_orders(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return q.page(orders, "o_orderkey", 100, after=1000)


@add("page_by_offset", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 25 OFFSET 50")
def page_by_offset(spark, sf):
    return q.page_by_offset(fx.table(spark, sf, "customer").select("c_custkey", "c_name"), ["c_custkey"], 25, 2)


@add(
    "catalog_columns",
    "SELECT 'events' AS table_name, * FROM (VALUES ('event_id', 'bigint', 1), ('event_type', 'string', 2)) "
    "v(column_name, data_type, ordinal_position) UNION ALL SELECT 'events', k, 'string', "
    "(2 + row_number() OVER (ORDER BY k))::INTEGER FROM (SELECT DISTINCT unnest(json_keys(props)) AS k FROM events)",
)
def catalog_columns(spark, sf):
    """Columns of events once its JSON fields became columns."""
    grown = evolve.add_json_columns(fx.table(spark, sf, "events").select("event_id", "event_type", "props"), "props")
    return q.catalog_columns(spark, {"events": grown})


