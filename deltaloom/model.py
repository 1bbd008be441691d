"""Table specs and the canonical change frame that every operator reads.

A change frame is a typed DataFrame with one row per captured change::

    _device_id, _device_name      which producer wrote it
    _segment, _seq, _txn_seq      total order of the changes of one device
    _commit_id                    commit time, epoch milliseconds
    _op                           one of the operation names below
    _set_cols                     columns the change names; null = all of them
    <table columns ...>

``_commit_id`` is a wall-clock reading, so two commits may share it: it is
never used as an order.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INSERT = "INSERT"
UPDATE = "UPDATE"
DELETE = "DELETE"
UPSERT = "UPSERT"
REPLACE = "REPLACE"
TRUNCATE = "TRUNCATE"
DELETE_WHERE = "DELETE_WHERE"
UPDATE_WHERE = "UPDATE_WHERE"

#: An insert that does nothing if the key is there; becomes an INSERT or nothing before the fold.
INSERT_IGNORE = "INSERT_IGNORE"

ROW_OPS = (INSERT, UPDATE, DELETE, UPSERT, REPLACE)
BULK_OPS = (DELETE_WHERE, UPDATE_WHERE)
#: Operations after which nothing older of the same key matters.
RESET_OPS = (INSERT, REPLACE, DELETE)
#: Operations that decide whether a key exists (an UPDATE never does).
LIFECYCLE_OPS = (INSERT, UPSERT, REPLACE, DELETE)

DEVICE_COLS = ("_device_id", "_device_name")
ORDER_COLS = ("_segment", "_seq", "_txn_seq")
CHANGE_COLS = (*DEVICE_COLS, *ORDER_COLS, "_commit_id", "_op", "_set_cols")
SYSTEM_COLS = ("sys_device_id", "sys_device_name", "sys_update_ts")

#: Segment number given to rows of a base snapshot: older than every change.
BASE_SEGMENT = -1

#: Declared type names (fixed values) and the Spark type that holds them.
DECLARED_TYPES = {
    "INTEGER": T.LongType(),
    "INT": T.LongType(),
    "BIGINT": T.LongType(),
    "REAL": T.DoubleType(),
    "TEXT": T.StringType(),
    "BLOB": T.BinaryType(),
}


def declared_type(name: str) -> T.DataType:
    """Spark type of a declared column type; unknown names are kept as text."""
    words = name.strip().upper().split()
    return DECLARED_TYPES.get(words[0] if words else "TEXT", T.StringType())


@dataclass(frozen=True)
class TableSpec:
    """Name, schema and key columns of a table (Spark enforces no keys itself)."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()

    def __post_init__(self):
        unknown = [k for k in self.keys if k not in self.schema.names]
        if unknown:
            raise ValueError(f"key columns {unknown} are not columns of {self.name}")

    @classmethod
    def of(cls, name: str, df: DataFrame, *keys: str) -> "TableSpec":
        columns = [f for f in df.schema.fields if f.name not in (*CHANGE_COLS, *SYSTEM_COLS)]
        return cls(name, T.StructType(columns), tuple(keys))

    @property
    def columns(self) -> list[str]:
        return list(self.schema.names)

    @property
    def values(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.keys]

    @property
    def row_key(self) -> list[str]:
        """Grouping columns of the fold: devices never share a row.

        Source keys come first. They tell rows apart sooner than the few device
        names do, so sorting by this list mostly compares one column.
        """
        return [*self.keys, *DEVICE_COLS]

    def with_schema(self, schema: T.StructType) -> "TableSpec":
        return replace(self, schema=schema)


def order_of(prefix: str = "") -> Column:
    """Position of a change in its device's log, comparable as one value."""
    return F.struct(*[F.col(prefix + c).alias(c) for c in ORDER_COLS])


def commit_time(commit_id: Column) -> Column:
    """Commit id as a zone-less timestamp, independent of the session zone."""
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_add("MILLISECOND", commit_id, epoch)


def as_changes(
    df: DataFrame,
    spec: TableSpec,
    *,
    device_id,
    device_name,
    op,
    segment,
    seq,
    commit_id,
    txn_seq=0,
    set_cols=None,
) -> DataFrame:
    """Typed rows -> change frame. Arguments are Columns or plain literals."""

    def column(value, dtype):
        value = value if isinstance(value, Column) else F.lit(value)
        return value.cast(dtype)

    if isinstance(set_cols, (list, tuple)):
        set_cols = F.array(*[F.lit(c) for c in set_cols])
    return df.select(
        column(device_id, "string").alias("_device_id"),
        column(device_name, "string").alias("_device_name"),
        column(segment, "bigint").alias("_segment"),
        column(seq, "bigint").alias("_seq"),
        column(txn_seq, "bigint").alias("_txn_seq"),
        column(commit_id, "bigint").alias("_commit_id"),
        column(op, "string").alias("_op"),
        column(set_cols, "array<string>").alias("_set_cols"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields],
    )


def base_changes(df: DataFrame, spec: TableSpec, device_id, device_name, commit_id=0) -> DataFrame:
    """A snapshot as INSERT changes older than any log row (operator A16)."""
    return as_changes(
        df,
        spec,
        device_id=device_id,
        device_name=device_name,
        op=INSERT,
        segment=BASE_SEGMENT,
        seq=0,
        commit_id=commit_id,
    )


_WIDENING = ("int", "bigint", "double", "string")


def common_type(left: str, right: str) -> str | None:
    """Type that holds values of both, or null when widening is not allowed.

    int -> bigint -> double -> string, float -> double, date -> timestamp, and a
    decimal to a larger one.
    """
    if left == right:
        return left
    pair = {left, right}
    for narrow, wide in (("float", "double"), ("date", "timestamp"), ("date", "timestamp_ntz")):
        if pair == {narrow, wide}:
            return wide
    if pair <= set(_WIDENING):
        return max(pair, key=_WIDENING.index)
    if left.startswith("decimal") and right.startswith("decimal"):
        (p1, s1), (p2, s2) = [map(int, t[8:-1].split(",")) for t in (left, right)]
        scale = max(s1, s2)
        return f"decimal({min(38, max(p1 - s1, p2 - s2) + scale)},{scale})"
    return None
