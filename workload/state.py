"""Folding, sync modes, write modes, bulk changes, filters and mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import fixtures as fx
from deltaloom.model import INSERT, REPLACE, TRUNCATE, UPSERT, TableSpec, as_changes, base_changes
from deltaloom.operators import barriers, modes
from deltaloom.operators import normalize as nz
from deltaloom.operators.fold import change_counts, compact, fold, last_images, merge, tag_devices
from deltaloom.plans.replay import (
    TRY_CREATE_DELETE_DATA,
    consolidate,
    initial_state,
    replica_of,
    replicate,
)
from workload import Registry
from workload import closed_forms as cf

registry = Registry()
add = registry.add


def money(column: str):
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


@add("consolidate_orders", cf.orders_rows())
def consolidate_orders(spark, sf):
    return consolidate(fx.orders_log(spark, sf), fx.orders_spec(spark, sf), fx.ORDERS_OPS)


@add(
    "consolidated_revenue_by_device",
    f"WITH t AS ({cf.orders_rows()}) SELECT sys_device_name, count(*) AS n_rows, {cf.total('o_totalprice')} AS revenue "
    "FROM t GROUP BY ROLLUP (sys_device_name)",
)
def consolidated_revenue_by_device(spark, sf):
    return consolidate_orders(spark, sf).rollup("sys_device_name").agg(
        F.count("*").alias("n_rows"), money("o_totalprice").alias("revenue")
    )


@add(
    "replicate_orders",
    f"SELECT device_id, o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM (SELECT {cf.DEVICE} AS device_id, "
    f"o_orderkey, {cf.STATUS} AS o_orderstatus, {cf.PRIORITY} AS o_orderpriority, o_totalprice FROM orders WHERE {cf.ALIVE})",
)
def replicate_orders(spark, sf):
    copies = replicate(fx.orders_log(spark, sf), fx.orders_spec(spark, sf), fx.ORDERS_OPS)
    return copies.select(
        F.col("_device_id").alias("device_id"), "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )


@add("replicate_orders_device0", cf.orders_rows(where=f"{cf.ALIVE} AND o_custkey % 4 = 0", system=False))
def replicate_orders_device0(spark, sf):
    copies = replicate(fx.orders_log(spark, sf), fx.orders_spec(spark, sf), fx.ORDERS_OPS)
    return replica_of(copies, "dev-0")


@add(
    "net_changes",
    f"SELECT {cf.DEVICE} AS device_id, o_orderkey, CASE WHEN {cf.ALIVE} THEN 'INSERT' ELSE 'DELETE' END AS op, "
    f"CASE WHEN {cf.ALIVE} THEN {cf.STATUS} END AS o_orderstatus, "
    f"CASE WHEN {cf.ALIVE} THEN {cf.PRIORITY} END AS o_orderpriority FROM orders",
)
def net_changes(spark, sf):
    short = compact(fx.orders_log(spark, sf), fx.orders_spec(spark, sf), fx.ORDERS_OPS)
    return short.select(
        F.col("_device_id").alias("device_id"), "o_orderkey", F.col("_op").alias("op"), "o_orderstatus", "o_orderpriority"
    )


@add(
    "last_full_images",
    "SELECT 'dev-0' AS device_id, o_custkey, max(o_orderkey) AS last_order, "
    "arg_max(o_totalprice, o_orderkey) AS last_price FROM orders GROUP BY o_custkey",
)
def last_full_images(spark, sf):
    """Every order is a full image of its customer's 'last order' row."""
    spec = TableSpec.of(
        "last_order", fx.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey"
    )
    images = fx.table(spark, sf, "orders")
    log = as_changes(
        images,
        spec,
        device_id="dev-0",
        device_name="branch-0",
        op=INSERT,
        segment=0,
        seq=F.col("o_orderkey"),
        commit_id=fx.commit_id(0, F.col("o_orderkey")),
    )
    return last_images(log, spec).select(
        F.col("_device_id").alias("device_id"),
        "o_custkey",
        F.col("o_orderkey").alias("last_order"),
        F.col("o_totalprice").alias("last_price"),
    )


@add(
    "change_counts",
    f"SELECT {cf.DEVICE} AS device_id, count(*) FILTER (o_orderkey % 7 = 0 AND o_orderkey % 21 = 0) AS inserted, "
    "count(*) FILTER (o_orderkey % 7 <> 0 AND o_orderkey % 10 = 0) AS updated, 0::BIGINT AS deleted "
    "FROM orders GROUP BY 1",
)
def change_counts_query(spark, sf):
    """Segments 0-2 are in the destination; 3-5 arrive."""
    spec = fx.orders_spec(spark, sf)
    before = fold(fx.orders_log(spark, sf, segments=range(3)), spec, fx.ORDERS_OPS)
    reported = merge(before, fx.orders_log(spark, sf, segments=range(3, 6)), spec, fx.ORDERS_OPS, report=True)
    return change_counts(reported, "_device_id").withColumnRenamed("_device_id", "device_id")


@add("merge_into_target", cf.orders_rows())
def merge_into_target(spark, sf):
    spec = fx.orders_spec(spark, sf)
    before = fold(fx.orders_log(spark, sf, segments=range(3)), spec, fx.ORDERS_OPS)
    after = merge(before, fx.orders_log(spark, sf, segments=range(3, 6)), spec, fx.ORDERS_OPS)
    return tag_devices(after, spec.columns)


NULL_NAME = "CASE WHEN o_custkey % 4 <> 2 THEN 'branch-' || (o_custkey % 4) END"


@add("merge_null_names", cf.orders_rows().replace(cf.NAME, NULL_NAME))
def merge_null_names(spark, sf):
    """dev-2 has no name: its rows meet their later changes all the same."""
    spec = fx.orders_spec(spark, sf)
    unnamed = F.when(F.col("_device_id") != "dev-2", F.col("_device_name"))
    log = fx.orders_log(spark, sf).withColumn("_device_name", unnamed)
    before = fold(log.where(F.col("_segment") < 3), spec, fx.ORDERS_OPS)
    return tag_devices(merge(before, log.where(F.col("_segment") >= 3), spec, fx.ORDERS_OPS), spec.columns)


@add("snapshot_seed", cf.orders_rows(stamp=None))
def snapshot_seed(spark, sf):
    spec = fx.orders_spec(spark, sf)
    device, name = fx.branch(F.col("o_custkey") % 4)
    base = base_changes(fx.table(spark, sf, "orders"), spec, device, name, fx.EPOCH)
    later = fx.orders_log(spark, sf, segments=range(1, 6))
    return consolidate(base.unionByName(later), spec, fx.ORDERS_OPS).drop("sys_update_ts")


@add(
    "init_delete_scoped",
    cf.orders_rows(where=f"{cf.ALIVE} AND o_custkey % 4 <> 0")
    + " UNION ALL "
    + cf.orders_rows("o_orderstatus", "o_orderpriority", "o_custkey % 4 = 0", cf.commit("0")),
)
def init_delete_scoped(spark, sf):
    """dev-0 starts over in a shared table: only its rows go, then it loads again."""
    spec = fx.orders_spec(spark, sf)
    existing = fold(fx.orders_log(spark, sf), spec, fx.ORDERS_OPS)
    devices = fx.orders_devices(spark, sf).where(F.col("_device_id") == "dev-0")
    state = initial_state(existing, devices, TRY_CREATE_DELETE_DATA, shared=True)
    again = fx.orders_log(spark, sf, segments=range(1)).where(F.col("_device_id") == "dev-0")
    return consolidate(again, spec, fx.ORDERS_OPS, state)


@add(
    "truncate_scoped",
    cf.orders_rows(where=f"{cf.ALIVE} AND (o_custkey % 4 <> 1 OR o_orderkey % 21 = 0)"),
)
def truncate_scoped(spark, sf):
    log = fx.orders_log(spark, sf).unionByName(fx.orders_truncate(spark, sf))
    return consolidate(log, fx.orders_spec(spark, sf), (*fx.ORDERS_OPS, TRUNCATE))


def unnamed(log: DataFrame, device: str) -> DataFrame:
    """The log as if one device had no name."""
    return log.withColumn("_device_name", F.when(F.col("_device_id") != device, F.col("_device_name")))


@add(
    "truncate_null_names",
    cf.orders_rows(where=f"{cf.ALIVE} AND (o_custkey % 4 <> 1 OR o_orderkey % 21 = 0)").replace(cf.NAME, NULL_NAME.replace("<> 2", "<> 1")),
)
def truncate_null_names(spark, sf):
    """dev-1 has no name; what it wrote before its TRUNCATE goes all the same."""
    log = unnamed(fx.orders_log(spark, sf).unionByName(fx.orders_truncate(spark, sf)), "dev-1")
    return consolidate(log, fx.orders_spec(spark, sf), (*fx.ORDERS_OPS, TRUNCATE))


@add(
    "init_delete_null_names",
    (
        cf.orders_rows(where=f"{cf.ALIVE} AND o_custkey % 4 <> 0")
        + " UNION ALL "
        + cf.orders_rows("o_orderstatus", "o_orderpriority", "o_custkey % 4 = 0", cf.commit("0"))
    ).replace(cf.NAME, NULL_NAME.replace("<> 2", "<> 0")),
)
def init_delete_null_names(spark, sf):
    """dev-0 has no name and starts over in a shared table: its rows go, then it loads again."""
    spec = fx.orders_spec(spark, sf)
    existing = fold(unnamed(fx.orders_log(spark, sf), "dev-0"), spec, fx.ORDERS_OPS)
    devices = unnamed(fx.orders_devices(spark, sf).where(F.col("_device_id") == "dev-0"), "dev-0")
    state = initial_state(existing, devices, TRY_CREATE_DELETE_DATA, shared=True)
    again = unnamed(fx.orders_log(spark, sf, segments=range(1)).where(F.col("_device_id") == "dev-0"), "dev-0")
    return consolidate(again, spec, fx.ORDERS_OPS, state)


def with_bulk(spark, sf, delete, update):
    spec = fx.orders_spec(spark, sf)
    bulk = fx.orders_bulk(spark, sf, delete, update)
    rows = barriers.fold_with_bulk(fx.orders_log(spark, sf), bulk, spec, fx.ORDERS_OPS)
    return tag_devices(rows, spec.columns)


GONE = "(o_custkey % 4 = 2 AND o_totalprice > 200000)"
# status R at the barrier: segment 3 set it, segment 4 did not change it
BULK_HIT = "o_custkey % 4 = 2 AND o_orderkey % 21 = 0 AND o_orderkey % 42 <> 0"
BULK_STATUS = f"CASE WHEN {BULK_HIT} THEN 'B' ELSE {cf.STATUS} END"


@add("delete_where_scoped", cf.orders_rows(where=f"{cf.ALIVE} AND NOT {GONE}"))
def delete_where_scoped(spark, sf):
    return with_bulk(spark, sf, True, False)


@add("update_where_scoped", cf.orders_rows(status=BULK_STATUS, stamp=None))
def update_where_scoped(spark, sf):
    return with_bulk(spark, sf, False, True).drop("sys_update_ts")


@add("bulk_changes_in_order", cf.orders_rows(BULK_STATUS, where=f"{cf.ALIVE} AND NOT {GONE}", stamp=None))
def bulk_changes_in_order(spark, sf):
    return with_bulk(spark, sf, True, True).drop("sys_update_ts")


@add(
    "bulk_null_names",
    cf.orders_rows(BULK_STATUS, where=f"{cf.ALIVE} AND NOT {GONE}", stamp=None).replace(cf.NAME, NULL_NAME),
)
def bulk_null_names(spark, sf):
    """dev-2, which issues the bulk statements, has no name."""
    spec = fx.orders_spec(spark, sf)
    log, bulk = (unnamed(x, "dev-2") for x in (fx.orders_log(spark, sf), fx.orders_bulk(spark, sf, True, True)))
    return tag_devices(barriers.fold_with_bulk(log, bulk, spec, fx.ORDERS_OPS), spec.columns).drop("sys_update_ts")


@add(
    "update_where_by_parameters",
    "WITH n AS (SELECT n_nationkey, 'seg-' || n_regionkey AS seg FROM nation) "
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, coalesce(seg, c_mktsegment) AS c_mktsegment "
    "FROM customer LEFT JOIN n ON c_nationkey = n_nationkey",
)
def update_where_by_parameters(spark, sf):
    """UPDATE customer SET c_mktsegment = ? WHERE c_nationkey = ?, once per nation: one run."""
    spec = fx.customer_spec(spark, sf)
    base = base_changes(fx.table(spark, sf, "customer"), spec, "dev-0", "branch-0", fx.EPOCH)
    bulk = barriers.bulk_rows(
        fx.table(spark, sf, "nation"),
        device_id=F.lit("dev-0"),
        device_name=F.lit("branch-0"),
        segment=F.lit(1),
        seq=F.col("n_nationkey"),
        commit_id=fx.commit_id(1, F.col("n_nationkey")),
        op="UPDATE_WHERE",
        terms=[("c_nationkey", "=", F.col("n_nationkey"))],
        values={"c_mktsegment": F.concat(F.lit("seg-"), F.col("n_regionkey"))},
    )
    return barriers.fold_with_bulk(base, bulk, spec, (INSERT,)).select(*spec.columns)


def customer_mode(spark, sf, mode) -> DataFrame:
    spec = fx.customer_spec(spark, sf)
    base = fx.customer_before(spark, sf)
    changes = modes.apply_mode(fx.customer_changes(spark, sf), spec, mode, base)
    ops = {UPSERT: (INSERT, UPSERT), REPLACE: (INSERT, REPLACE), INSERT: (INSERT,)}[mode]
    return fold(base.unionByName(changes), spec, ops).select(*spec.columns)


def customer_sql(even_changed: bool, keep: bool) -> str:
    """End state of the customer log: which columns a change on an existing key leaves."""
    changed = "c_custkey % 3 = 0"
    new = f"({changed} AND c_custkey % 2 = 1)"
    hit = changed if even_changed else new
    rest = f"CASE WHEN {new if keep else hit} THEN NULL ELSE {{0}} END AS {{0}}"
    return (
        f"SELECT c_custkey, {rest.format('c_name')}, {rest.format('c_nationkey')}, "
        f"CASE WHEN {hit} THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal, {rest.format('c_mktsegment')} "
        "FROM customer"
    )


@add("upsert_customers", customer_sql(True, True))
def upsert_customers(spark, sf):
    return customer_mode(spark, sf, UPSERT)


@add("replace_customers", customer_sql(True, False))
def replace_customers(spark, sf):
    return customer_mode(spark, sf, REPLACE)


@add("insert_mode_customers", customer_sql(False, False))
def insert_mode_customers(spark, sf):
    return customer_mode(spark, sf, INSERT)


@add(
    "append_mode_customers",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 <> 0 UNION ALL "
    "SELECT c_custkey, NULL, NULL, 0.0::DOUBLE, NULL FROM customer WHERE c_custkey % 3 = 0",
)
def append_mode_customers(spark, sf):
    base = fx.customer_before(spark, sf).select(*fx.customer_spec(spark, sf).columns)
    changes = fx.customer_changes(spark, sf)
    return modes.append_rows(base, modes.apply_mode(changes, fx.customer_spec(spark, sf), "APPEND"))


@add(
    "conflict_report",
    "SELECT 'customer' AS table_name, 'insert_existing' AS kind, count(*) AS n FROM customer WHERE c_custkey % 6 = 0 "
    "UNION ALL SELECT 'customer', 'update_missing', count(*) FROM customer "
    "WHERE c_custkey % 5 = 0 AND c_custkey % 2 <> 0 AND c_custkey % 3 <> 0 "
    "UNION ALL SELECT 'customer', 'delete_missing', count(*) FROM customer WHERE c_custkey % 20 = 0",
)
def conflict_report(spark, sf):
    return modes.conflict_counts(fx.customer_conflicting(spark, sf), fx.customer_spec(spark, sf))


@add(
    "committed_only",
    cf.orders_rows(
        status=cf.STATUS.replace("o_orderkey % 5 = 0", "(o_orderkey % 5 = 0 AND o_orderkey % 97 <> 0)"), stamp=None
    ),
)
def committed_only(spark, sf):
    log = nz.committed_only(fx.orders_log(spark, sf), fx.orders_commits(spark, sf))
    return consolidate(log, fx.orders_spec(spark, sf), fx.ORDERS_OPS).drop("sys_update_ts")


@add(
    "committed_single_writer",
    cf.orders_rows(
        status="CASE WHEN o_orderkey % 21 = 0 THEN 'R' WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END",
        priority="o_orderpriority",
        stamp=None,
    ),
)
def committed_single_writer(spark, sf):
    """Devices that overwrite their one commit row: it names the last commit, here the last one of segment 3."""
    log = fx.orders_log(spark, sf)
    last = log.where(F.col("_segment") <= 3).groupBy("_device_id").agg(F.max("_commit_id").alias("_commit_id"))
    kept = nz.committed_only(log, last, last.select("_device_id"))
    return consolidate(kept, fx.orders_spec(spark, sf), fx.ORDERS_OPS).drop("sys_update_ts")


@add(
    "dedupe_replay",
    f"WITH {cf.orders_log(False)} SELECT device_id, segment, op, count(*) AS n FROM log GROUP BY 1, 2, 3",
)
def dedupe_replay(spark, sf):
    log = nz.drop_redelivered(fx.orders_log(spark, sf))
    return log.groupBy(
        F.col("_device_id").alias("device_id"), F.col("_segment").alias("segment"), F.col("_op").alias("op")
    ).agg(F.count("*").alias("n"))


# the marks stop inside a segment only where its last key of the device lies
@add(
    "after_high_mark",
    f"WITH {cf.orders_log()}, {cf.MARKS} SELECT log.device_id, log.segment, seq, op FROM log "
    "LEFT JOIN marks USING (device_id) WHERE marks.segment IS NULL OR log.segment > marks.segment",
)
def after_high_mark(spark, sf):
    left = nz.after_marks(fx.orders_log(spark, sf), fx.orders_marks(spark, sf))
    return left.select(
        F.col("_device_id").alias("device_id"),
        F.col("_segment").alias("segment"),
        F.col("_seq").alias("seq"),
        F.col("_op").alias("op"),
    )


@add(
    "table_filter",
    "SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer",
)
def table_filter(spark, sf):
    """Include orders, customer and part; exclude part: a table on both lists is out."""
    tagged = None
    for name, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey"), ("supplier", "s_suppkey")):
        rows = fx.table(spark, sf, name).select(F.lit(name).alias("_table"), F.col(key).alias("key"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    kept = nz.only_tables(tagged, include=["orders", "customer", "part"], exclude=["part"])
    return kept.groupBy(F.col("_table").alias("table_name")).agg(F.count("*").alias("n"))


@add(
    "column_mapping",
    f"SELECT o_orderkey, o_custkey, {cf.STATUS} AS status, o_totalprice AS price, {cf.PRIORITY} AS o_orderpriority "
    f"FROM orders WHERE {cf.ALIVE}",
)
def column_mapping(spark, sf):
    mapped = nz.map_columns(
        fx.orders_log(spark, sf), {"o_orderstatus": "status", "o_totalprice": "price"}, skip=["o_orderdate"]
    )
    spec = TableSpec.of("orders", mapped, "o_orderkey")
    return fold(mapped, spec, fx.ORDERS_OPS).select(*spec.columns)


@add("value_filter", f"SELECT * FROM ({cf.orders_rows()}) WHERE o_totalprice > 100000 AND o_orderstatus <> 'X'")
def value_filter(spark, sf):
    return nz.keep_rows(consolidate_orders(spark, sf), "o_totalprice > 100000 AND o_orderstatus <> 'X'")


@add(
    "value_filter_changes",
    f"SELECT o_orderkey, CASE WHEN {cf.ALIVE} AND o_totalprice > 100000 THEN 'REPLACE' ELSE 'DELETE' END AS op, "
    f"CASE WHEN {cf.ALIVE} AND o_totalprice > 100000 THEN {cf.STATUS} END AS o_orderstatus FROM orders "
    "WHERE o_orderkey % 21 = 0 OR (o_orderkey % 7 <> 0 AND o_orderkey % 10 = 0)",
)
def value_filter_changes(spark, sf):
    """A filtered destination: touched rows outside the predicate arrive as deletes."""
    spec = fx.orders_spec(spark, sf)
    before = fold(fx.orders_log(spark, sf, segments=range(3)), spec, fx.ORDERS_OPS)
    reported = merge(before, fx.orders_log(spark, sf, segments=range(3, 6)), spec, fx.ORDERS_OPS, report=True)
    return nz.filter_changes(reported, spec, "o_totalprice > 100000").select(
        "o_orderkey", F.col("_op").alias("op"), "o_orderstatus"
    )


PAYLOAD = "CASE WHEN event_id % 50 = 0 THEN 'garbage' ELSE event_id::VARCHAR END"


@add("type_mapping", f"SELECT event_id, TRY_CAST({PAYLOAD} AS BIGINT) AS code FROM events WHERE event_id % 50 <> 0")
def type_mapping(spark, sf):
    messages = fx.messages(spark, sf).select("event_id", F.split("payload", ";")[0].alias("code"))
    return nz.map_types(messages, {"code": "bigint"})[0]


@add("type_mapping_rejects", "SELECT event_id, 'garbage' AS code, 'code' AS failed FROM events WHERE event_id % 50 = 0")
def type_mapping_rejects(spark, sf):
    messages = fx.messages(spark, sf).select("event_id", F.split("payload", ";")[0].alias("code"))
    rejected = nz.map_types(messages, {"code": "bigint"})[1]
    return rejected.select("event_id", "code", F.array_join("_failed", ",").alias("failed"))


@add(
    "column_filter",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
)
def column_filter(spark, sf):
    return nz.only_columns(
        fx.table(spark, sf, "lineitem"), include=["l_orderkey", "l_partkey", "l_quantity", "l_tax"], exclude=["l_tax"]
    )


@add(
    "device_tagging",
    "SELECT 'dev-' || (user_id % 4) AS sys_device_id, 'branch-' || (user_id % 4) AS sys_device_name, "
    f"{cf.at(cf.commit('0', 'event_id'))} AS sys_update_ts, event_id, event_type, value FROM events",
)
def device_tagging(spark, sf):
    device, name = fx.branch(F.col("user_id") % 4)
    rows = fx.table(spark, sf, "events").select(
        device.alias("_device_id"),
        name.alias("_device_name"),
        fx.commit_id(0, F.col("event_id")).alias("_commit_id"),
        "event_id",
        "event_type",
        "value",
    )
    return tag_devices(rows, ["event_id", "event_type", "value"])
