"""Change logs applied to destinations in either sync mode."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.functions.columns import join_same
from deltaloom.model import BULK_OPS, DEVICE_COLS, INSERT, INSERT_IGNORE, ROW_OPS, TRUNCATE, TableSpec, order_of
from deltaloom.operators.barriers import BULK_COLS, fold_with_bulk
from deltaloom.operators.carry import fill_statements
from deltaloom.operators.evolve import (
    CONSOLIDATION,
    REPLICATION,
    ignored_ddl,
    move_bulk,
    move_columns,
    read_ddl,
    schema_histories,
    source_columns,
    target_spec,
    with_known_schema,
)
from deltaloom.operators.fold import fold, merge, tag_devices
from deltaloom.operators.modes import settle_ignored
from deltaloom.operators.normalize import LOG_COLS, STATEMENT_ROWS, deduce_changes, unrecognised
from deltaloom.storage import broadcast_checked, compiled_in_parts, cut_lineage

# Destination init modes
OVERWRITE_OBJECT = "OVERWRITE_OBJECT"
TRY_CREATE_DELETE_DATA = "TRY_CREATE_DELETE_DATA"
TRY_CREATE_APPEND_DATA = "TRY_CREATE_APPEND_DATA"
APPEND_DATA = "APPEND_DATA"


def fold_log(changes: DataFrame, spec: TableSpec, ops: Iterable[str] = ROW_OPS, state: DataFrame | None = None) -> DataFrame:
    return fold(changes, spec, ops) if state is None else merge(state, changes, spec, ops)


def consolidate(
    changes: DataFrame, spec: TableSpec, ops: Iterable[str] = ROW_OPS, state: DataFrame | None = None
) -> DataFrame:
    """One shared table, keyed by device and source key, system columns first."""
    return tag_devices(fold_log(changes, spec, ops, state), spec.columns)


def replicate(
    changes: DataFrame, spec: TableSpec, ops: Iterable[str] = ROW_OPS, state: DataFrame | None = None
) -> DataFrame:
    """Every device's own copy; the device columns only say which copy."""
    return fold_log(changes, spec, ops, state).select(*DEVICE_COLS, *spec.columns)


def replica_of(replicated: DataFrame, device_id: str) -> DataFrame:
    """One device's table, 1:1 with its source."""
    return replicated.where(F.col("_device_id") == device_id).drop(*DEVICE_COLS)


def state_of(consolidated: DataFrame, spec: TableSpec) -> DataFrame:
    """Consolidated table -> state frame, to go on merging into it."""
    millis = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("sys_update_ts"))
    return consolidated.select(
        F.col("sys_device_id").alias("_device_id"),
        F.col("sys_device_name").alias("_device_name"),
        millis.alias("_commit_id"),
        *spec.columns,
    )


def initial_state(existing: DataFrame | None, devices: DataFrame, init_mode: str, shared: bool) -> DataFrame | None:
    """What a device finds at the destination when it starts.

    ``existing`` is a state frame, or None when the table does not exist yet.
    In a shared table, overwriting removes only the rows of ``devices``.
    """
    if init_mode == APPEND_DATA:
        if existing is None:
            raise ValueError("APPEND_DATA needs an existing table")
        return existing
    if init_mode == TRY_CREATE_APPEND_DATA:
        return existing
    if init_mode in (OVERWRITE_OBJECT, TRY_CREATE_DELETE_DATA):
        if existing is None or (init_mode == OVERWRITE_OBJECT and not shared):
            return None
        return join_same(existing, devices.select(*DEVICE_COLS), DEVICE_COLS, "left_anti")
    raise ValueError(f"unknown init mode {init_mode}")


@dataclass
class Replayed:
    """Result of replaying a command log into one destination table."""

    spec: TableSpec
    rows: DataFrame
    rejected: DataFrame
    ignored: DataFrame


def replay_commands(log: DataFrame, table: str, mode: str, filled: bool = False, hold_refused: bool = False) -> Replayed:
    """Command log -> destination table: statements, DDL, bulk changes and all.

    The log needs the columns of ``normalize.LOG_COLS``. Set ``filled`` when
    batched rows already carry their statement. With ``hold_refused`` a device
    stops before its first statement that is refused (reported either way).
    """
    if mode not in (REPLICATION, CONSOLIDATION):
        raise ValueError("the sync mode must be named: REPLICATION or CONSOLIDATION")
    if not filled:
        log = fill_statements(log)
    # written once: it may come from files read in Python, or from the fill, and the schema history and the deduction both read it
    log = cut_lineage(log.select(*LOG_COLS), "log")
    ddl = cut_lineage(read_ddl(log), "ddl")
    histories, spec = _schemas(ddl, table, mode)
    # written once: the steps below read it several times, each a few columns and operations
    with compiled_in_parts(log.sparkSession):
        deduced = cut_lineage(deduce_changes(with_known_schema(log, histories)), "deduced")
    refused = unrecognised(deduced)
    if hold_refused:
        first = cut_lineage(refused.groupBy(*DEVICE_COLS).agg(F.min(order_of()).alias("_held")), "held")
        if not first.isEmpty():
            # what stands before a refused statement was deduced with the schema before it, whatever DDL follows
            deduced = _before(deduced, first, F.floor(F.col("_txn_seq") / STATEMENT_ROWS).cast("bigint"))
            ddl = _before(ddl, first, F.col("_txn_seq"))
            histories, spec = _schemas(ddl, table, mode)
    found = {r["_op"] for r in deduced.select("_op").distinct().collect()}
    as_text = list(dict.fromkeys(s for s, _ in source_columns(histories, table)))
    wide = bind_any(deduced, as_text)
    changes = move_columns(wide, histories, spec)
    if INSERT_IGNORE in found:
        if found & set(BULK_OPS):
            raise ValueError("inserts that ignore conflicts cannot be folded together with bulk changes")
        changes = settle_ignored(changes, spec)
        found = (found - {INSERT_IGNORE}) | {INSERT}
    bulk = move_bulk(bulk_any(deduced), histories, spec)
    ops = found & {*ROW_OPS, TRUNCATE}
    rows = fold_with_bulk(changes, bulk, spec, ops) if found & set(BULK_OPS) else fold(changes, spec, ops)
    rows = tag_devices(rows, spec.columns) if mode == CONSOLIDATION else rows.select(*DEVICE_COLS, *spec.columns)
    ignored = ignored_ddl(ddl) if mode == CONSOLIDATION else ignored_ddl(ddl.where(F.col("_op").isNull()))
    return Replayed(spec, rows, refused, ignored)


def _schemas(ddl: DataFrame, table: str, mode: str) -> tuple[DataFrame, TableSpec]:
    """Schema history of all tables, and the destination table at the end of the log."""
    histories = schema_histories(ddl, mode)
    spec = target_spec(histories, table, replicated=mode == REPLICATION)
    if not spec.columns:
        raise ValueError(f"table {table} does not exist at the end of the log")
    return histories, spec


def _before(rows: DataFrame, held: DataFrame, place: Column) -> DataFrame:
    """Rows of statements before the place at which their device is held; ``place`` is the statement's number in its transaction."""
    at = F.struct("_segment", "_seq", (place * STATEMENT_ROWS).alias("_txn_seq"))
    marked = join_same(rows, broadcast_checked(held), DEVICE_COLS, "left")
    return marked.where(F.col("_held").isNull() | (at < F.col("_held"))).select(*rows.columns)


def bind_any(deduced: DataFrame, columns: list[str]) -> DataFrame:
    """Bound values of any table's rows as text columns, next to ``_table``."""

    def value(c: str):
        return F.coalesce(F.try_element_at("_set", F.lit(c)), F.try_element_at("_where", F.lit(c))).cast("string").alias(c)

    return deduced.where(F.col("_op").isNotNull() & F.col("_op").isin(*ROW_OPS, INSERT_IGNORE, TRUNCATE)).select(
        *DEVICE_COLS,
        "_segment",
        "_seq",
        "_txn_seq",
        "_commit_id",
        "_op",
        F.map_keys("_set").alias("_set_cols"),
        "_table",
        *[value(c) for c in columns],
    )


def bulk_any(deduced: DataFrame) -> DataFrame:
    return deduced.where(F.col("_op").isin(*BULK_OPS)).select(*BULK_COLS, "_table")

