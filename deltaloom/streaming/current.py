"""The current row of every key, kept as state inside the stream.

For destinations that take row updates and cannot be rewritten: each micro-batch
emits the rows that changed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from deltaloom.functions.columns import latest, name, text
from deltaloom.model import CHANGE_COLS, DELETE, INSERT, ORDER_COLS, REPLACE, RESET_OPS, ROW_OPS, UPDATE, UPSERT, TableSpec

#: State store that keeps large state on disk instead of in executor memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _input_names(spec: TableSpec) -> list[str]:
    return [*CHANGE_COLS, *spec.columns]


def _output_names(spec: TableSpec) -> list[str]:
    return ["_device_id", "_device_name", *spec.keys, "_live", "_commit_id", *spec.values]


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value.item() if hasattr(value, "item") else value


def _advance(known: tuple, changes: Iterator[dict], names: list[str]) -> tuple:
    """Apply a key's changes, in order, to ``(live, segment, seq, txn_seq, commit, *values)``."""
    live, at, commit, values = known[0], tuple(known[1:4]), known[4], list(known[5:])
    for change in changes:
        place = tuple(int(change[c]) for c in ORDER_COLS)
        if place <= at:
            continue  # delivered before
        at, op, named = place, change["_op"], change["_set_cols"]
        new = [_plain(change[c]) for c in names]
        touched = [named is None or c in list(named) for c in names]
        if op == DELETE:
            live, values, commit = False, [None] * len(names), int(change["_commit_id"])
        elif op in (INSERT, REPLACE):
            live, values, commit = True, [v if t else None for v, t in zip(new, touched)], int(change["_commit_id"])
        elif op == UPSERT or live:
            # a row that does not exist has no values, so both cases read the same
            values = [v if t else old for v, t, old in zip(new, touched, values)]
            live, commit = True, int(change["_commit_id"])
    return (live, *at, commit, *values)


def current_rows(changes: DataFrame, spec: TableSpec, ops: Iterable[str] = ROW_OPS) -> DataFrame:
    """Stream of changed rows; ``_live`` false means the row was deleted, and ``_commit_id`` is then the DELETE's.

    ``ops`` states which operations the stream can hold, as for a fold; a row with another one fails the query. Without UPSERT the state of a key
    is a handful of maxima, kept by Spark's own aggregation. An UPSERT's row begins at the first one after the last DELETE, which no maximum
    tells, so with them the changes of a key are visited one by one in Python. Feed it a compacted log
    (:func:`deltaloom.streaming.apply.start_compaction`): then a call sees at
    most two rows per key and file, however often the key changed.
    """
    ops = set(ops)
    return _visited(changes, spec) if UPSERT in ops else _aggregated(changes, spec, ops)


def _aggregated(changes: DataFrame, spec: TableSpec, ops: set[str]) -> DataFrame:
    """Last whole row and last writer per column, as in :func:`deltaloom.operators.fold.summarise`, in the state of a streaming aggregation.

    A position carries when it was first seen: a key is emitted if what decides its row came with this batch, not if it was delivered again.
    """
    now = "-unix_millis(current_timestamp())"
    at = f"struct({', '.join(ORDER_COLS)}, _seen)"
    whole = f"_op IN ({', '.join(text(o) for o in RESET_OPS)})"
    known = ", ".join(text(o) for o in ROW_OPS if o in ops) or "NULL"
    fields = {c: spec.schema[c].dataType for c in spec.values}

    def named(column: str) -> str:
        return f"(_set_cols IS NULL OR array_contains(_set_cols, {text(column)}))"

    checked = f"CASE WHEN _op IN ({known}) THEN _op ELSE raise_error(concat('operation outside the declared set: ', _op)) END AS _op"
    kept = changes.selectExpr(
        *[name(c) for c in (*spec.row_key, *spec.values)], *ORDER_COLS, "_commit_id", "_set_cols", checked, f"{now} AS _seen"
    )
    images = [f"CASE WHEN _op <> {text(DELETE)} AND {named(c)} THEN {name(c)} END AS c{i}" for i, c in enumerate(fields)]
    image = f"struct({', '.join(['_op AS op', '_commit_id AS commit', *images])})"
    aggregates = {"_full": latest(at, image, fields.values(), whole)}
    if UPDATE in ops:
        aggregates["_part"] = latest(at, "_commit_id", (), f"NOT {whole}")
        aggregates |= {f"_w{i}": latest(at, name(c), [t], f"NOT {whole} AND {named(c)}") for i, (c, t) in enumerate(fields.items())}
    grouped = kept.groupBy(*spec.row_key).agg(*[F.expr(a).alias(n) for n, a in aggregates.items()])
    alive = f"(_full IS NOT NULL AND _full.v.op <> {text(DELETE)})"

    def value(index: int, column: str) -> str:
        own = f"CASE WHEN _w{index}.o > _full.o THEN _w{index}.v ELSE _full.v.c{index} END" if UPDATE in ops else f"_full.v.c{index}"
        return f"CASE WHEN {alive} THEN {own} END AS {name(column)}"

    commit = f"CASE WHEN {alive} AND _part.o > _full.o THEN _part.v ELSE coalesce(_full.v.commit, 0) END" if UPDATE in ops else "_full.v.commit"
    new = " OR ".join(f"coalesce({a}.o._seen = {now}, false)" for a in aggregates)
    rows = grouped.where(new).selectExpr(
        *[name(c) for c in spec.row_key],
        f"{alive} AS _live",
        f"{commit} AS _commit_id",
        *[value(i, c) for i, c in enumerate(fields)],
    )
    return rows.select(*_output_names(spec))


def _visited(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The changes of each key, in order, in a Python call per key and batch."""
    types = {f.name: f.dataType.simpleString() for f in spec.schema.fields}
    # pandas has no null beside 64-bit integers or decimals: these travel as text and stay exact
    exact = {f.name: f.dataType for f in spec.schema.fields if f.name in spec.values and isinstance(f.dataType, (T.LongType, T.DecimalType))}
    types |= {c: "string" for c in exact}
    types |= {"_device_id": "string", "_device_name": "string", "_live": "boolean", "_commit_id": "bigint"}
    read, written = _input_names(spec), _output_names(spec)
    key_names = spec.row_key

    def advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(chunks)).set_axis(read, axis=1).sort_values(list(ORDER_COLS))
        known = tuple(state.get) if state.exists else (False, -2, 0, 0, 0, *[None] * len(spec.values))
        now = _advance(known, rows.to_dict("records"), spec.values)
        if now == known:
            return
        state.update(now)
        out = {**dict(zip(key_names, key)), "_live": now[0], "_commit_id": now[4], **dict(zip(spec.values, now[5:]))}
        yield pd.DataFrame({f"r{i}": pd.Series([out[c]], dtype=object) for i, c in enumerate(written)})

    # positional names: leading underscores do not survive the way into Python state functions
    inputs = {c: f"c{i}" for i, c in enumerate(read)}
    output = ", ".join(f"r{i} {types[c]}" for i, c in enumerate(written))
    state = "live boolean, segment bigint, seq bigint, txn_seq bigint, commit bigint" + "".join(
        f", v{i} {types[c]}" for i, c in enumerate(spec.values)
    )
    rows = (
        changes.select(*[(changes[c].cast("string") if c in exact else changes[c]).alias(short) for c, short in inputs.items()])
        .groupBy(*[inputs[c] for c in key_names])
        .applyInPandasWithState(advance, output, state, "update", GroupStateTimeout.NoTimeout)
    )
    return rows.toDF(*written).withColumns({c: F.col(c).cast(kind) for c, kind in exact.items()})
