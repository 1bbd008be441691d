"""Fold an ordered change log into table rows.

The fold is one grouped aggregate per table. For a key it keeps

* the last *reset* (INSERT, REPLACE or DELETE) with its row image: nothing older matters,
* per column, the last partial change that wrote it, with its position,
* the first and the last UPSERT.

Those are plain maxima and minima. Spark therefore merges them on the map side
before the shuffle, a key that owns a third of the log reaches its reducer as
one row per map task, and repeated deliveries of a log row change nothing. No
window over a key's history is needed.

One case does not fit maxima: a key whose last reset is a DELETE and that was
upserted both before and after it. The row then starts at the first UPSERT
*after* the DELETE. :func:`summarise` looks that position up in a second
aggregate, for those keys only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.functions.columns import join_same, latest, name, text
from deltaloom.model import (
    DELETE,
    DEVICE_COLS,
    INSERT,
    ORDER_COLS,
    REPLACE,
    RESET_OPS,
    ROW_OPS,
    TRUNCATE,
    UPDATE,
    UPSERT,
    TableSpec,
    commit_time,
    order_of,
)


POSITION = f"struct({', '.join(ORDER_COLS)})"
ORDER_TYPE = f"struct<{', '.join(f'{c}:bigint' for c in ORDER_COLS)}>"


def _writer(column: str) -> str:
    """Summary column with the last writer of a table column, quoted for SQL text."""
    return name(f"_w_{column}")


def after_truncate(changes: DataFrame) -> DataFrame:
    """Drop what a device wrote before its own last TRUNCATE."""
    cuts = truncated_devices(changes)
    return (
        join_same(changes.where(F.col("_op") != TRUNCATE), cuts, DEVICE_COLS, "left")
        .where(F.col("_cut").isNull() | (order_of() > F.col("_cut")))
        .drop("_cut")
    )


def truncated_devices(changes: DataFrame) -> DataFrame:
    return (
        changes.where(F.col("_op") == TRUNCATE).groupBy(*DEVICE_COLS).agg(F.max(order_of()).alias("_cut"))
    )


#: Tasks a key's rows are dealt out to, at most, before they are combined.
SPREAD = 16


def spread(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Deal rows read from log files out by key, a key with many rows to several tasks.

    Aggregates of strings and structs sort their input, and a split of a log file, bounded in bytes, holds as many rows as compress into
    it. After a shuffle a task combines what Spark's advisory size lets it have, however well the files are compressed.
    """
    return changes.repartition(*spec.row_key, F.pmod(F.xxhash64(*ORDER_COLS), F.lit(SPREAD)))


def summarise(
    changes: DataFrame, spec: TableSpec, ops: Iterable[str] = ROW_OPS, by: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key with everything needed to resolve it, with or without a base.

    ``by`` names further grouping columns, such as the epoch of a change.
    ``ops`` states which operations the log can hold. The full set is the
    default; naming fewer lets the plan skip work, and a row with any other
    operation fails the query rather than being folded wrongly.
    """
    ops = set(ops)
    if TRUNCATE in ops:
        changes = after_truncate(changes)
    known = ", ".join(text(o) for o in ROW_OPS if o in ops) or "NULL"
    group = [*spec.row_key, *by]
    kept = changes.select(
        *group,
        *spec.values,
        *ORDER_COLS,
        "_commit_id",
        "_set_cols",
        F.expr(
            f"CASE WHEN _op IN ({known}) THEN _op "
            "ELSE raise_error(concat('operation outside the declared set: ', _op)) END AS _op"
        ),
    )

    def named(column: str) -> str:
        return f"(_set_cols IS NULL OR array_contains(_set_cols, {text(column)}))"

    # Expressions are SQL text: a wide table needs hundreds of them, and text
    # reaches the JVM in one call where nested Column objects take dozens.
    # Rows that replace the whole row feed one aggregate, partial rows only
    # those of the columns they name: a change costs what it writes.
    whole = f"_op IN ({', '.join(text(o) for o in RESET_OPS)})"
    images = [
        f"CASE WHEN _op <> {text(DELETE)} AND {named(c)} THEN {name(c)} END AS c{i}" for i, c in enumerate(spec.values)
    ]
    image = f"struct({', '.join(['_op AS op', '_commit_id AS commit', *images])})"
    types = {c: spec.schema[c].dataType for c in spec.values}
    aggregates = [latest(POSITION, image, types.values(), whole) + " AS _full"]
    if ops & {UPDATE, UPSERT}:
        aggregates.append(latest(POSITION, "_commit_id", (), f"NOT {whole}") + " AS _part")
        for c in spec.values:
            own = latest(POSITION, name(c), [types[c]], f"NOT {whole} AND {named(c)}")
            aggregates.append(f"{own} AS {_writer(c)}")
    if UPSERT in ops:
        upsert = f"CASE WHEN _op = {text(UPSERT)} THEN {POSITION} END"
        aggregates += [f"min({upsert}) AS _first_up", f"max({upsert}) AS _last_up"]
    grouped = kept.groupBy(*group).agg(*[F.expr(a) for a in aggregates])
    return _with_start(_per_column(grouped, spec, group, ops), kept, spec, ops, group)


def _per_column(grouped: DataFrame, spec: TableSpec, group: list[str], ops: set[str]) -> DataFrame:
    """Last writer per column, be it a whole row or a partial change."""
    live = f"CASE WHEN _full IS NOT NULL AND _full.v.op <> {text(DELETE)} THEN struct(_full.o AS o, _full.v.commit AS v) END"
    partial = "_part" in grouped.columns

    def writer(index: int, column: str) -> str:
        whole = f"CASE WHEN _full IS NOT NULL THEN struct(_full.o AS o, _full.v.c{index} AS v) END"
        if not partial:
            return f"{whole} AS {_writer(column)}"
        own = _writer(column)
        later = f"{own} IS NOT NULL AND (_full IS NULL OR {own}.o > _full.o)"
        return f"CASE WHEN {later} THEN {own} ELSE {whole} END AS {own}"

    return grouped.selectExpr(
        *[name(c) for c in group],
        "CASE WHEN _full IS NOT NULL THEN struct(_full.o AS o, _full.v.op AS op) END AS _reset",
        (f"greatest({live}, _part)" if partial else live) + " AS _last",
        *[c if UPSERT in ops else f"CAST(NULL AS {ORDER_TYPE}) AS {c}" for c in ("_first_up", "_last_up")],
        *[writer(i, c) for i, c in enumerate(spec.values)],
    )


def _with_start(summary: DataFrame, kept: DataFrame, spec: TableSpec, ops: set[str], group: list[str]) -> DataFrame:
    """Add ``_start``: the position at which the current row of the key began."""
    reset = F.col("_reset")
    summary = summary.withColumn(
        "_start",
        F.expr(
            f"CASE WHEN _reset.op IN ({text(INSERT)}, {text(REPLACE)}) THEN _reset.o "
            "WHEN _reset IS NULL OR _first_up > _reset.o THEN _first_up "
            "WHEN _last_up > _reset.o THEN _last_up END"
        ),
    )
    if not {UPSERT, DELETE} <= ops:
        return summary
    # Upserted before and after its last DELETE, and some column was last
    # written between that DELETE and the last UPSERT.
    between = F.expr(
        " OR ".join(f"({_writer(c)}.o > _reset.o AND {_writer(c)}.o < _last_up)" for c in spec.values) or "false"
    )
    unclear = summary.where(
        (reset["op"] == DELETE) & (F.col("_first_up") < reset["o"]) & (F.col("_last_up") > reset["o"]) & between
    ).select(*group, reset["o"].alias("_after"))
    exact = (
        join_same(kept.where(F.col("_op") == UPSERT).select(*group, *ORDER_COLS), unclear, group)
        .where(order_of() > F.col("_after"))
        .groupBy(*group)
        .agg(F.min(order_of()).alias("_exact"))
    )
    return (
        join_same(summary, exact, group, "left")
        .withColumn("_start", F.coalesce("_exact", "_start"))
        .drop("_exact")
    )


def _folded_value(column: str) -> str:
    return f"CASE WHEN {_writer(column)}.o >= _start THEN {_writer(column)}.v END"


def fold(changes: DataFrame, spec: TableSpec, ops: Iterable[str] = ROW_OPS) -> DataFrame:
    """Live rows after all changes: row key, ``_commit_id`` of the last one, columns."""
    return resolve(summarise(changes, spec, ops), spec)


def resolve(summary: DataFrame, spec: TableSpec) -> DataFrame:
    return summary.where("_start IS NOT NULL").selectExpr(
        *DEVICE_COLS,
        "_last.v AS _commit_id",
        *[name(c) if c in spec.keys else f"{_folded_value(c)} AS {name(c)}" for c in spec.columns],
    )


def merge(
    state: DataFrame,
    changes: DataFrame,
    spec: TableSpec,
    ops: Iterable[str] = ROW_OPS,
    report: bool = False,
) -> DataFrame:
    """Current state (as returned by :func:`fold`) + a change batch -> new state.

    The batch is summarised first and joined to the state once, by key. A full
    outer join on the raw rows could not tell "set to null" from "not named";
    the summary can. With ``report`` the result keeps deleted keys and carries
    ``_effect`` (inserted, updated, deleted, untouched, none) for A15.
    """
    ops = set(ops)
    if TRUNCATE in ops:
        cuts = truncated_devices(changes).select(*DEVICE_COLS, F.lit(True).alias("_emptied"))
        state = join_same(state, cuts, DEVICE_COLS, "left")
    return apply_summary(before_batch(state, spec), summarise(changes, spec, ops), spec, report)


def before_batch(state: DataFrame, spec: TableSpec) -> DataFrame:
    """State rows under names that cannot meet those of a summary."""
    emptied = "coalesce(_emptied, false)" if "_emptied" in state.columns else "false"
    return state.selectExpr(
        *[name(c) for c in spec.row_key],
        "_commit_id AS _b_commit",
        "true AS _exists",
        f"{emptied} AS _emptied",
        *[f"{name(c)} AS {name('_b_' + c)}" for c in spec.values],
    )


def apply_summary(was: DataFrame, summary: DataFrame, spec: TableSpec, report: bool) -> DataFrame:
    """State before a batch joined to the summary of the batch -> state after it."""
    both = join_same(was, summary.withColumn("_touched", F.lit(True)), spec.row_key, "full")
    joined = both.selectExpr(
        "*", "coalesce(_exists, false) AND NOT coalesce(_emptied, false) AND _reset IS NULL AS _keeps"
    )

    def value(column: str) -> str:
        own = _writer(column)
        kept = f"CASE WHEN {own} IS NOT NULL THEN {own}.v ELSE {name('_b_' + column)} END"
        return f"CASE WHEN _keeps THEN {kept} ELSE {_folded_value(column)} END AS {name(column)}"

    live = "(_keeps OR _start IS NOT NULL)"
    columns = [
        *DEVICE_COLS,
        "coalesce(_last.v, _b_commit) AS _commit_id",
        *[name(c) if c in spec.keys else value(c) for c in spec.columns],
    ]
    if not report:
        return joined.where(live).selectExpr(*columns)
    effect = (
        f"CASE WHEN _exists AND NOT {live} THEN 'deleted' WHEN NOT {live} THEN 'none' "
        "WHEN _exists IS NULL THEN 'inserted' WHEN _touched THEN 'updated' ELSE 'untouched' END AS _effect"
    )
    return joined.selectExpr(*columns, effect)


def change_counts(reported: DataFrame, *by: str) -> DataFrame:
    """Inserted / updated / deleted rows of a reported merge."""
    effects = ("inserted", "updated", "deleted")
    return reported.groupBy(*by).agg(*[F.count_if(F.col("_effect") == e).alias(e) for e in effects])


def compact(changes: DataFrame, spec: TableSpec, ops: Iterable[str] = ROW_OPS) -> DataFrame:
    """The shortest log with the same effect, itself a valid change frame.

    A key with a reset becomes one INSERT or DELETE. A key without one becomes
    one UPDATE and/or one UPSERT: updates before the first UPSERT only matter
    to a row that already exists, so they cannot be mixed into it.
    """
    summary = summarise(changes, spec, ops)
    reset, start, first_up = F.col("_reset"), F.col("_start"), F.col("_first_up")

    def part(op: str, at: Column, columns: Column, keep: Column) -> Column:
        return F.when(keep, F.struct(F.lit(op).alias("_op"), at.alias("_at"), columns.alias("_set_cols")))

    def written(condition) -> Column:
        names = [
            F.when(F.col(_writer(c)).isNotNull() & condition(F.col(_writer(c))["o"]), F.lit(c)) for c in spec.values
        ]
        return F.array_compact(F.array(*names)).cast("array<string>")

    every = F.lit(None).cast("array<string>")
    early = written(lambda o: first_up.isNull() | (o < first_up))
    late = written(lambda o: o >= first_up)
    early_at = F.when(first_up.isNull(), F.col("_last")["o"]).otherwise(
        F.array_max(
            F.array(*[F.when(F.col(_writer(c))["o"] < first_up, F.col(_writer(c))["o"]) for c in spec.values])
        )
        if spec.values
        else first_up
    )
    parts = F.array_compact(
        F.array(
            part(DELETE, reset["o"], every, reset.isNotNull() & start.isNull()),
            part(INSERT, F.col("_last")["o"], every, reset.isNotNull() & start.isNotNull()),
            part(UPDATE, early_at, early, reset.isNull() & (F.size(early) > 0)),
            part(UPSERT, F.col("_last")["o"], late, reset.isNull() & first_up.isNotNull()),
        )
    )
    rows = summary.withColumn("_part", F.explode(parts))
    picked = F.col("_part")
    is_full = picked["_op"] == INSERT
    is_part = picked["_op"].isin(UPDATE, UPSERT)

    def value(column: str) -> Column:
        writer = F.col(_writer(column))
        shown = F.when(is_full, F.expr(_folded_value(column)))
        return shown.when(is_part & F.array_contains(picked["_set_cols"], column), writer["v"])

    return rows.select(
        *DEVICE_COLS,
        *[picked["_at"][c].alias(c) for c in ORDER_COLS],
        F.coalesce(F.col("_last")["v"], F.lit(0)).cast("bigint").alias("_commit_id"),
        picked["_op"].alias("_op"),
        picked["_set_cols"].alias("_set_cols"),
        *[F.col(c) if c in spec.keys else value(c).alias(c) for c in spec.columns],
    )


def last_images(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """A09 for logs whose rows are all full images: keep the last row per key."""
    payload = F.struct("_commit_id", "_op", "_set_cols", *spec.values)
    picked = changes.groupBy(*spec.row_key).agg(
        F.max_by(F.struct(order_of().alias("o"), payload.alias("p")), order_of()).alias("_x")
    )
    x = F.col("_x")
    return picked.select(
        *DEVICE_COLS,
        *[x["o"][c].alias(c) for c in ORDER_COLS],
        *[x["p"][c].alias(c) for c in ("_commit_id", "_op", "_set_cols")],
        *[F.col(c) if c in spec.keys else x["p"][c].alias(c) for c in spec.columns],
    )


def tag_devices(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Put the three system columns in front of a row."""
    return rows.select(
        F.col("_device_id").alias("sys_device_id"),
        F.col("_device_name").alias("sys_device_name"),
        commit_time(F.col("_commit_id")).alias("sys_update_ts"),
        *columns,
    )
