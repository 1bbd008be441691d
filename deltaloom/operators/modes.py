"""Write modes per table and the conflict report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaloom.model import BASE_SEGMENT, DELETE, INSERT, INSERT_IGNORE, LIFECYCLE_OPS, REPLACE, UPDATE, UPSERT, TableSpec
from deltaloom.operators.carry import CHUNK_ROWS, carry_forward


def with_liveness(
    changes: DataFrame, spec: TableSpec, chunk_rows: int = CHUNK_ROWS, transactions: bool = False, lifecycle_ops: Iterable[str] = LIFECYCLE_OPS
) -> DataFrame:
    """Add ``_alive``: did the key exist just before this change?

    Only the last INSERT, UPSERT, REPLACE or DELETE before it decides that.
    Base rows take part when they are in the frame as INSERTs.
    """
    lifecycle = F.when(F.col("_op").isin(*lifecycle_ops), F.col("_op"))
    once = drop_redelivered_rows(changes, spec)
    seen = carry_forward(once, spec.row_key, lifecycle, "_before", False, chunk_rows, transactions)
    return seen.withColumn("_alive", F.coalesce(F.col("_before") != DELETE, F.lit(False))).drop("_before")


def drop_redelivered_rows(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """One copy per log position and key (base rows share one position)."""
    return changes.dropDuplicates(["_device_id", "_device_name", "_segment", "_seq", "_txn_seq", *spec.keys])


def apply_mode(
    changes: DataFrame, spec: TableSpec, mode: str, base: DataFrame | None = None, transactions: bool = False
) -> DataFrame:
    """A10: rewrite INSERT changes according to the table's write mode.

    INSERT   an insert on an existing key is dropped (see :func:`conflicts`)
    UPSERT   inserts update the named columns of an existing row
    REPLACE  inserts replace the whole row
    APPEND   only inserts are kept; nothing is folded
    ``base`` (as INSERT changes) and ``transactions`` (see
    :func:`~deltaloom.operators.carry.carry_forward`) matter to INSERT mode only.
    """
    op = F.col("_op")
    if mode == UPSERT:
        return changes.withColumn("_op", F.when(op == INSERT, F.lit(UPSERT)).otherwise(op))
    if mode == REPLACE:
        return changes.withColumn("_op", F.when(op == INSERT, F.lit(REPLACE)).otherwise(op))
    if mode == "APPEND":
        return changes.where(op == INSERT)
    if mode != INSERT:
        raise ValueError(f"unknown write mode {mode}")
    log = changes if base is None else base.unionByName(changes)
    kept = with_liveness(log, spec, transactions=transactions).where(~((op == INSERT) & F.col("_alive")))
    if base is not None:
        kept = kept.where(F.col("_segment") > BASE_SEGMENT)
    return kept.select(*changes.columns)


def settle_ignored(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Inserts that do nothing on an existing key become plain ones, or go.

    After one its key exists in either case, so whether a key existed before a change follows from the last change that decides
    it, as in INSERT mode. Bulk changes are not seen here.
    """
    ignoring = F.col("_op") == INSERT_IGNORE
    seen = with_liveness(changes, spec, lifecycle_ops=(*LIFECYCLE_OPS, INSERT_IGNORE))
    kept = seen.where(~(ignoring & F.col("_alive"))).withColumn("_op", F.when(ignoring, F.lit(INSERT)).otherwise(F.col("_op")))
    return kept.select(*changes.columns)


def append_rows(base: DataFrame, changes: DataFrame) -> DataFrame:
    """APPEND: every insert becomes a row; there is no key to conflict on."""
    columns = [c for c in changes.columns if c in base.columns]
    return base.unionByName(changes.where(F.col("_op") == INSERT).select(*columns), allowMissingColumns=True)


def conflicts(changes: DataFrame, spec: TableSpec, transactions: bool = False) -> DataFrame:
    """Changes that a strict destination would have refused."""
    op, alive = F.col("_op"), F.col("_alive")
    kind = (
        F.when((op == INSERT) & alive, "insert_existing")
        .when((op == UPDATE) & ~alive, "update_missing")
        .when((op == DELETE) & ~alive, "delete_missing")
    )
    return with_liveness(changes, spec, transactions=transactions).withColumn("kind", kind).where(F.col("kind").isNotNull())


def conflict_counts(changes: DataFrame, spec: TableSpec) -> DataFrame:
    return (
        conflicts(changes, spec)
        .groupBy(F.lit(spec.name).alias("table_name"), "kind")
        .agg(F.count("*").alias("n"))
    )

