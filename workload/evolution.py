"""Schema evolution, command logs, log segments."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from deltaloom.model import INSERT
from deltaloom.operators import evolve
from deltaloom.operators.carry import fill_statements
from deltaloom.operators.normalize import bind, deduce_changes, expand_transactions
from deltaloom.operators.tables import insert_rows
from deltaloom.operators.validate import inspect_log
from deltaloom.plans.replay import consolidate, replay_commands, replicate
from deltaloom.sources import segments as sg
from deltaloom.storage import fresh_dir
from workload import Registry
from workload import closed_forms as cf

registry = Registry()
add = registry.add

PART_DEVICE = "'dev-' || (p_partkey % 2) AS sys_device_id, 'branch-' || (p_partkey % 2) AS sys_device_name"
PART_STAMP = cf.at(cf.commit("CASE WHEN p_partkey % 4 IN (0, 1) THEN 1 ELSE 3 END", "p_partkey"))


def evolved(spark, sf, mode):
    histories = evolve.schema_histories(fx.part_ddl(spark, sf), mode)
    spec = evolve.target_spec(histories, "part", mode == evolve.REPLICATION)
    changes = evolve.move_columns(fx.part_changes(spark, sf), histories, spec)
    return (replicate if mode == evolve.REPLICATION else consolidate)(changes, spec, (INSERT,))


@add(
    "evolve_consolidation",
    f"SELECT {PART_DEVICE}, {PART_STAMP} AS sys_update_ts, p_partkey, CASE WHEN p_partkey % 4 <> 3 THEN p_name END AS p_name, "
    "CASE WHEN p_partkey % 4 <> 3 THEN p_size::BIGINT END AS p_size, CASE WHEN p_partkey % 4 = 2 THEN 't' END AS tag, "
    "CASE WHEN p_partkey % 4 = 3 THEN p_size::BIGINT END AS p_sz FROM part",
)
def evolve_consolidation(spark, sf):
    return evolved(spark, sf, evolve.CONSOLIDATION)


@add(
    "evolve_replication",
    "SELECT 'dev-' || (p_partkey % 2) AS device_id, p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS p_name, "
    "CASE WHEN p_partkey % 2 = 0 THEN p_size::BIGINT END AS p_size, CASE WHEN p_partkey % 4 = 2 THEN 't' END AS tag, "
    "CASE WHEN p_partkey % 2 = 1 THEN p_size::BIGINT END AS p_sz FROM part",
)
def evolve_replication(spark, sf):
    rows = evolved(spark, sf, evolve.REPLICATION)
    return rows.withColumnRenamed("_device_id", "device_id").drop("_device_name")


@add(
    "ignored_ddl",
    "SELECT 'dev-' || c_custkey AS device_id, lower(c_mktsegment) AS table_name, "
    "CASE WHEN c_custkey % 10 = 0 THEN 'DROP_TABLE' ELSE 'DROP_COLUMN' END AS op, "
    "CASE WHEN c_custkey % 10 = 0 THEN 'table is shared by all devices' "
    "ELSE 'column is shared by all devices' END AS reason FROM customer WHERE c_custkey % 10 IN (0, 1)",
)
def ignored_ddl(spark, sf):
    report = evolve.ignored_ddl(fx.customer_ddl(spark, sf))
    return report.withColumnRenamed("_device_id", "device_id").drop("_commit_id")


def renamed(spark, sf, mode, table):
    ddl, changes = fx.supplier_ddl(spark, sf), fx.supplier_changes(spark, sf)
    histories = evolve.schema_histories(ddl, mode)
    spec = evolve.target_spec(histories, table, mode == evolve.REPLICATION)
    moved = evolve.move_columns(changes, histories, spec)
    return (replicate if mode == evolve.REPLICATION else consolidate)(moved, spec, (INSERT,))


SUPPLIER = "'dev-' || (s_suppkey % 3)"


@add(
    "rename_table_replication",
    f"SELECT {SUPPLIER} AS device_id, s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 <> 2",
)
def rename_table_replication(spark, sf):
    """Rows written under the old name are found under the new one; dev-2 dropped its table."""
    rows = renamed(spark, sf, evolve.REPLICATION, "vendor")
    return rows.select(F.col("_device_id").alias("device_id"), "s_suppkey", "s_name")


@add(
    "rename_table_consolidation",
    f"SELECT 'supplier' AS table_name, {SUPPLIER} AS device_id, s_suppkey FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL "
    f"SELECT 'vendor', {SUPPLIER}, s_suppkey FROM supplier WHERE s_suppkey % 2 = 1 AND s_suppkey % 3 <> 2",
)
def rename_table_consolidation(spark, sf):
    """The old table stays as it was, later rows land in the new one; the drop is ignored."""
    tables = [
        renamed(spark, sf, evolve.CONSOLIDATION, name).select(
            F.lit(name).alias("table_name"), F.col("sys_device_id").alias("device_id"), "s_suppkey"
        )
        for name in ("supplier", "vendor")
    ]
    return tables[0].unionByName(tables[1])


@add(
    "widen_types",
    "SELECT p_partkey, p_size::DOUBLE AS measure FROM part WHERE p_partkey % 2 = 0 UNION ALL "
    "SELECT p_partkey, p_retailprice FROM part WHERE p_partkey % 2 = 1",
)
def widen_types(spark, sf):
    part = fx.table(spark, sf, "part")
    narrow = part.where(F.col("p_partkey") % 2 == 0).select("p_partkey", F.col("p_size").alias("measure"))
    wide = part.where(F.col("p_partkey") % 2 == 1).select("p_partkey", F.col("p_retailprice").alias("measure"))
    return evolve.union_evolving(narrow, wide)


@add(
    "auto_add_columns",
    "SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def auto_add_columns(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "event_type", "props")
    return evolve.add_json_columns(events, "props", {"k": "bigint"})


@add(
    "auto_add_many_columns",
    "SELECT event_id, k, '{\"f' || event_id || '\":' || event_id || ',\"k\":' || k || '}' AS rest "
    "FROM (SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)",
)
def auto_add_many_columns(spark, sf):
    """A field name of its own in every event: the frequent field becomes a column, the others stay in a variant."""
    events = fx.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))
    text = F.concat(F.lit('{"k":'), "k", F.lit(',"f'), "event_id", F.lit('":'), "event_id", F.lit("}"))
    wide = evolve.add_json_columns(events.select("event_id", text.alias("props")), "props", {"k": "bigint"}, most=1)
    return wide.select("event_id", "k", F.to_json("_rest").alias("rest"))


@add(
    "insert_unseen_columns",
    "SELECT c_custkey, c_name, NULL AS source FROM customer WHERE c_custkey % 2 = 0 UNION ALL "
    "SELECT c_custkey, c_name, 'web' FROM customer WHERE c_custkey % 2 = 1",
)
def insert_unseen_columns(spark, sf):
    customer = fx.table(spark, sf, "customer").select("c_custkey", "c_name")
    old = customer.where(F.col("c_custkey") % 2 == 0)
    new = customer.where(F.col("c_custkey") % 2 == 1).withColumn("source", F.lit("web"))
    return insert_rows(old, new)


@add(
    "inferred_types_with_overrides",
    "SELECT s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_acctbal FROM supplier",
)
def inferred_types_with_overrides(spark, sf):
    path = fresh_dir(spark, "supplier-csv")
    fx.table(spark, sf, "supplier").write.option("header", True).csv(path)
    found = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return evolve.override_types(found, {"s_suppkey": "bigint", "s_nationkey": "string"})


# -- statements ----------------------------------------------------------------------------


@add(
    "fill_statements",
    "SELECT 'INSERT' AS verb, count(*) AS n FROM orders UNION ALL "
    "SELECT 'UPDATE', count(*) FILTER (o_orderkey % 5 = 0) + count(*) FILTER (o_orderkey % 14 = 0) + "
    "count(*) FILTER (o_orderkey % 10 = 0) FROM orders UNION ALL "
    "SELECT 'DELETE', count(*) FROM orders WHERE o_orderkey % 7 = 0 UNION ALL "
    "SELECT 'INSERT', count(*) FROM orders WHERE o_orderkey % 21 = 0",
)
def fill_statements_query(spark, sf):
    """Statement verbs after batched rows got their text back (the two INSERT waves apart)."""
    filled = fill_statements(fx.orders_commands(spark, sf)).where(F.col("_seq") > 1)
    wave = F.when(F.col("_segment") >= 3, 3).otherwise(0)
    verb = F.substring("sql", 1, 6)
    grouped = F.when(verb == "UPDATE", 0).otherwise(wave)
    return filled.groupBy(verb.alias("verb"), grouped.alias("_w")).agg(F.count("*").alias("n")).drop("_w")


@add(
    "statement_to_changes",
    f"SELECT {cf.DEVICE} AS device_id, o_orderkey, {cf.STATUS} AS o_orderstatus, o_totalprice, "
    f"{cf.PRIORITY} AS o_orderpriority FROM orders WHERE {cf.ALIVE}",
)
def statement_to_changes(spark, sf):
    """Command log of orders: DDL, batched and parameterised statements -> folded rows."""
    table = replay_commands(fx.orders_commands(spark, sf), "orders", evolve.CONSOLIDATION)
    return table.rows.select(
        F.col("sys_device_id").alias("device_id"), "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@add(
    "bound_changes",
    f"WITH {cf.orders_log(False)} SELECT op, segment, o_orderkey, CASE WHEN segment IN (1, 4) THEN 'o_orderstatus' "
    "WHEN segment = 5 THEN 'o_orderpriority' END AS named FROM log",
)
def bound_changes(spark, sf):
    """Statement by statement: operation, key and assigned columns."""
    spec = fx.orders_text_spec(spark)
    log = fx.orders_commands(spark, sf, batched=False).where((F.col("_seq") > 1) & ~F.col("sql").startswith("CREATE"))
    rows = bind(deduce_changes(log, [spec]), spec)
    return rows.select(
        F.col("_op").alias("op"),
        F.col("_segment").alias("segment"),
        "o_orderkey",
        F.when(F.col("_op") == "UPDATE", F.array_join("_set_cols", ",")).alias("named"),
    )


# -- forms of INSERT --------------------------------------------------------------------------------

SHAPED = """SELECT 'dev-' || (o_orderkey // 2 % 4) AS device_id, o_orderkey,
    CASE WHEN {late} AND o_orderkey % 9 = 0 THEN 'again?' WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderstatus || ' (it''s), a' END AS o_orderstatus,
    CASE WHEN {late} AND o_orderkey % 9 = 0 THEN 1 ELSE o_totalprice END AS o_totalprice FROM orders
    UNION ALL SELECT 'dev-' || (o_orderkey // 2 % 4), o_orderkey + 1000000000, 'one', 2 FROM orders WHERE o_orderkey % 10 = 0 AND {late}"""


@add("statement_shapes", SHAPED.format(late="true"))
def statement_shapes(spark, sf):
    """Several rows of values in one statement, bound and literal ones mixed, OR IGNORE, and ON CONFLICT DO NOTHING."""
    rows = replay_commands(fx.shaped_commands(spark, sf), "orders", evolve.CONSOLIDATION).rows
    return rows.select(F.col("sys_device_id").alias("device_id"), "o_orderkey", "o_orderstatus", "o_totalprice")


@add("refused_statement_holds", SHAPED.format(late="(o_orderkey // 2 % 4 <> 2)"))
def refused_statement_holds(spark, sf):
    """dev-2 issues a statement that is refused: nothing behind it is applied for that device, the others go on."""
    rows = replay_commands(fx.shaped_commands(spark, sf, refused=True), "orders", evolve.CONSOLIDATION, hold_refused=True).rows
    return rows.select(F.col("sys_device_id").alias("device_id"), "o_orderkey", "o_orderstatus", "o_totalprice")


# -- defaults and widening -------------------------------------------------------------------------

RATING = "CASE WHEN s_suppkey % 10 = 0 THEN 2.5 WHEN s_suppkey % 6 = 0 THEN 0 WHEN s_suppkey % 4 = 1 THEN s_suppkey ELSE 7 END::DOUBLE AS rating"
NOTE = "CASE WHEN s_suppkey % 10 <> 0 THEN 'it''s new, so far' END AS s_note"
SUPPLIERS = f"SELECT 'dev-' || (s_suppkey % 3) AS device_id, s_suppkey, s_name, {NOTE}, {RATING} FROM supplier"


@add("add_column_default", SUPPLIERS)
def add_column_default(spark, sf):
    """Rows older than a column, and rows that do not name it, read its default; then the column is widened by a statement."""
    rows = replay_commands(fx.supplier_commands(spark, sf), "supplier", evolve.CONSOLIDATION).rows
    return rows.select(F.col("sys_device_id").alias("device_id"), "s_suppkey", "s_name", "s_note", "rating")


@add("widen_by_statement", SUPPLIERS.replace("AS device_id", "AS device_id, 'double' AS kind"))
def widen_by_statement(spark, sf):
    """The same replicated: the destination's column takes the wider type, and values written before keep theirs."""
    rows = replay_commands(fx.supplier_commands(spark, sf), "supplier", evolve.REPLICATION).rows
    kind = dict(rows.dtypes)["rating"]
    return rows.select(F.col("_device_id").alias("device_id"), F.lit(kind).alias("kind"), "s_suppkey", "s_name", "s_note", "rating")


# -- segment files ------------------------------------------------------------------------------


def staged(spark, sf):
    return fx.stage_segments(spark, sf, fresh_dir(spark, "stage"))


SEG_STATUS = cf.STATUS.replace("o_orderkey % 5 = 0", "(o_orderkey % 5 = 0 AND o_custkey % 4 <> 2)")


@add(
    "segment_scan",
    f"WITH {cf.orders_log(False)} SELECT device_id, segment, count(*) AS n FROM log "
    "GROUP BY 1, 2",
)
def segment_scan(spark, sf):
    """Rows of the staged SQLite segments; dev-3 publishes transactions, which stand in files of their own."""
    stage = staged(spark, sf)
    log, _ = expand_transactions(sg.scan_log(spark, stage, fx.STAGE_PATTERN), sg.scan_transactions(spark, stage, fx.STAGE_PATTERN))
    data = log.where(~F.col("sql").startswith("CREATE"))
    return data.groupBy(
        F.col("_device_id").alias("device_id"), F.floor(F.col("_segment") / fx.ROLLS).alias("segment")
    ).agg(F.count("*").alias("n"))


@add(
    "segment_metadata",
    f"WITH {cf.orders_log(False)} SELECT DISTINCT device_id, segment * {10**6} + o_orderkey // 50000 AS segment, "
    "CASE WHEN device_id = 'dev-2' AND segment = 1 THEN 'APPLIED' ELSE 'READY_TO_APPLY' END AS status FROM log",
)
def segment_metadata(spark, sf):
    rows = sg.segment_metadata(sg.scan_metadata(spark, staged(spark, sf), fx.STAGE_PATTERN))
    return rows.select(F.col("uuid").alias("device_id"), F.col("_segment").alias("segment"), "status")


@add(
    "replay_segments",
    f"SELECT {cf.DEVICE} AS device_id, o_orderkey, {SEG_STATUS} AS o_orderstatus, o_totalprice, "
    f"{cf.PRIORITY} AS o_orderpriority FROM orders WHERE {cf.ALIVE}",
)
def replay_segments(spark, sf):
    """All staged files: segments, published transactions, metadata -> consolidated table."""
    log, _ = fx.read_stage(spark, staged(spark, sf))
    table = replay_commands(log, "orders", evolve.CONSOLIDATION, filled=True)
    return table.rows.select(
        F.col("sys_device_id").alias("device_id"), "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@add(
    "replay_txn",
    f"WITH {cf.orders_log(False)} SELECT segment, commit_id - seq % 10000 AS commit_id, count(*) AS n, "
    "min(seq) AS first_key, max(seq) AS last_key FROM log WHERE device_id = 'dev-3' GROUP BY 1, 2",
)
def replay_txn(spark, sf):
    """Published transactions of dev-3 expanded in master order."""
    stage = staged(spark, sf)
    master = sg.scan_log(spark, stage, fx.STAGE_PATTERN).where(F.col("_device_id") == "dev-3")
    log, _ = expand_transactions(master, sg.scan_transactions(spark, stage, fx.STAGE_PATTERN))
    data = log.where(~F.col("sql").startswith("CREATE"))
    return data.groupBy(F.floor(F.col("_segment") / fx.ROLLS).alias("segment"), F.col("_commit_id").alias("commit_id")).agg(
        F.count("*").alias("n"), F.min("_txn_seq").alias("first_key"), F.max("_txn_seq").alias("last_key")
    )


@add(
    "unpublished_txn",
    f"SELECT {cf.DEVICE} AS device_id, min(o_orderkey) AS first_key FROM orders WHERE o_custkey % 4 = 3 GROUP BY 1",
)
def unpublished_txn(spark, sf):
    """With every transaction of dev-3 lost, the report names where it is held back."""
    stage = staged(spark, sf)
    master = sg.scan_log(spark, stage, fx.STAGE_PATTERN)
    none = sg.scan_transactions(spark, stage, fx.STAGE_PATTERN).where(F.lit(False))
    _, unmatched = expand_transactions(master, none)
    held = unmatched.groupBy("_device_id").agg(F.min(F.struct("_segment", "_seq")).alias("_at"))
    return held.select(F.col("_device_id").alias("device_id"), F.col("_at")["_seq"].alias("first_key"))


@add(
    "log_inspection",
    f"WITH {cf.orders_log(False)} SELECT device_id, segment, count(*) AS n FROM log GROUP BY 1, 2",
)
def log_inspection(spark, sf):
    log = fx.orders_commands(spark, sf).where(F.col("_seq") > 1)
    counts = inspect_log(log)["counts"]
    return counts.select(
        F.col("_device_id").alias("device_id"), F.col("_segment").alias("segment"), F.col("n_rows").alias("n")
    )


@add(
    "last_log_rows",
    f"WITH {cf.orders_log(False)} SELECT device_id, segment, seq + 2 AS seq FROM log "
    "ORDER BY segment DESC, seq DESC, device_id LIMIT 5",
)
def last_log_rows(spark, sf):
    rows = inspect_log(fx.orders_commands(spark, sf))["last_rows"]
    return rows.select(
        F.col("_device_id").alias("device_id"), F.col("_segment").alias("segment"), F.col("_seq").alias("seq")
    )


