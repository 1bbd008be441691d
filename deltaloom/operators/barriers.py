"""Predicate-based UPDATE and DELETE at their place in the log.

A bulk change acts on whatever rows its predicate finds at that moment, so the
log is cut there: fold what came before, apply the bulk change, go on. Devices
do not see each other's rows, so the first bulk change of every device is
applied in the same round, then the second, and so on: the number of rounds is
the largest number of bulk runs of one device, however many devices there are.

A bulk frame has ``_device_id, _device_name, _segment, _seq, _txn_seq,
_commit_id, _op`` and ``_terms`` (column, operator, value; joined by AND),
``_predicate`` (free SQL text, used where ``_terms`` is null) and ``_set``
(column -> value). Values are bytes of their text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.functions.columns import all_of, is_true, join_same
from deltaloom.model import (
    BULK_OPS,
    DELETE_WHERE,
    DEVICE_COLS,
    ORDER_COLS,
    ROW_OPS,
    TRUNCATE,
    TableSpec,
    order_of,
)
from deltaloom.operators.fold import (
    after_truncate,
    apply_summary,
    before_batch,
    fold,
    merge,
    resolve,
    summarise,
    truncated_devices,
)
from deltaloom.operators.normalize import STATEMENT_ROWS, bound_cast
from deltaloom.storage import broadcast_counted, cut_lineage

BULK_COLS = (*DEVICE_COLS, *ORDER_COLS, "_commit_id", "_op", "_terms", "_predicate", "_set")
TERM_TYPE = "array<struct<column:string,operator:string,value:binary>>"


def bulk_changes(deduced: DataFrame, table: str) -> DataFrame:
    """Bulk rows of one table from deduced statements."""
    return deduced.where((F.lower("_table") == table.lower()) & F.col("_op").isin(*BULK_OPS)).select(*BULK_COLS)


def bulk_rows(
    df: DataFrame,
    *,
    device_id: Column,
    device_name: Column,
    segment: Column,
    seq: Column,
    commit_id: Column,
    op: str,
    terms: list[tuple[str, str, Column]] | None = None,
    predicate: str | None = None,
    values: dict[str, Column] | None = None,
) -> DataFrame:
    """Bulk frame from a frame with one row per bulk statement."""

    def raw(value: Column) -> Column:
        return value.cast("string").cast("binary")

    listed = (
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.lit(o).alias("operator"), raw(v).alias("value"))
                for c, o, v in terms
            ]
        )
        if terms
        else F.lit(None)
    )
    assigned = F.create_map(*[x for c, v in values.items() for x in (F.lit(c), raw(v))]) if values else F.lit(None)
    return df.select(
        device_id.cast("string").alias("_device_id"),
        device_name.cast("string").alias("_device_name"),
        segment.cast("bigint").alias("_segment"),
        seq.cast("bigint").alias("_seq"),
        F.lit(0).cast("bigint").alias("_txn_seq"),
        commit_id.cast("bigint").alias("_commit_id"),
        F.lit(op).alias("_op"),
        listed.cast(TERM_TYPE).alias("_terms"),
        F.lit(predicate).cast("string").alias("_predicate"),
        assigned.cast("map<string,binary>").alias("_set"),
    )


def _shaped(bulk: DataFrame) -> DataFrame:
    """Add the statement shape, and whether equal shapes in a row act as one."""
    names = F.transform("_terms", lambda t: t["column"])
    operators = F.transform("_terms", lambda t: t["operator"])
    assigned = F.array_sort(F.coalesce(F.map_keys("_set"), F.array().cast("array<string>")))
    independent = ~F.arrays_overlap(names, assigned) | (F.col("_op") == DELETE_WHERE)
    only_equal = F.size(F.filter(operators, lambda o: o != F.lit("="))) == 0
    return bulk.dropDuplicates([*DEVICE_COLS, *ORDER_COLS]).select(
        *BULK_COLS,
        F.struct(
            F.col("_op").alias("op"),
            names.alias("names"),
            operators.alias("operators"),
            assigned.alias("assigned"),
            F.col("_predicate").alias("predicate"),
            F.coalesce(only_equal & independent & (F.size("_terms") > 0), F.lit(False)).alias("joinable"),
        ).alias("_shape"),
    )


def run_starts(shaped: DataFrame) -> DataFrame:
    """Per device the positions where a run of bulk changes starts.

    A row continues a run when the row directly before it in the log is a bulk
    row of the same shape. That is an equi-join on the position, so a device
    with millions of parameter rows stays distributed.
    """
    here = shaped.where(F.col("_shape")["joinable"]).select(
        *DEVICE_COLS, "_segment", "_seq", "_txn_seq", F.xxhash64("_shape").alias("_h")
    )
    following = here.select(
        *DEVICE_COLS,
        "_segment",
        "_h",
        F.explode(
            F.array(
                F.struct((F.col("_seq") + 1).alias("_seq"), F.lit(0).cast("bigint").alias("_txn_seq")),
                F.struct(F.col("_seq").alias("_seq"), (F.col("_txn_seq") + 1).alias("_txn_seq")),
                # the next statement of a transaction, see normalize.split_rows
                F.struct(F.col("_seq").alias("_seq"), ((F.floor(F.col("_txn_seq") / STATEMENT_ROWS) + 1) * STATEMENT_ROWS).cast("bigint").alias("_txn_seq")),
            )
        ).alias("_next"),
    ).select(*DEVICE_COLS, "_segment", "_h", "_next.*")
    key = [*DEVICE_COLS, "_segment", "_seq", "_txn_seq", "_h"]
    following = following.withColumn("_joined", F.lit(True)).dropDuplicates(key)
    starts = join_same(shaped.withColumn("_h", F.xxhash64("_shape")), following, key, "left")
    starts = starts.where(F.col("_joined").isNull() | ~F.col("_shape")["joinable"])
    return starts.groupBy(*DEVICE_COLS).agg(F.array_sort(F.collect_set(order_of())).alias("_runs"))


def _typed(spec: TableSpec, column: str, value: Column) -> Column:
    return bound_cast(value, spec.schema[column].dataType)


def _compare(left: Column, operator: str, right: Column) -> Column:
    return {
        "=": left == right,
        "<>": left != right,
        "!=": left != right,
        "<": left < right,
        "<=": left <= right,
        ">": left > right,
        ">=": left >= right,
    }[operator]


def apply_run(state: DataFrame, run: DataFrame, shapes: list, spec: TableSpec) -> DataFrame:
    """Apply one run of bulk changes per device to the state.

    ``shapes`` lists the statement shapes of the run with their row counts.
    """
    for shape, count in shapes:
        rows = run.where(F.col("_shape").eqNullSafe(_literal_shape(shape)))
        names = list(dict.fromkeys(shape["names"] or []))
        change = F.struct(F.col("_set"), F.col("_commit_id"))
        if shape["joinable"]:

            def wanted(c: str) -> Column:
                term = F.element_at(F.filter("_terms", lambda t: t["column"] == F.lit(c)), 1)
                return _typed(spec, c, term["value"])

            values = {f"_v{i}": wanted(c) for i, c in enumerate(names)}
            hits = (
                rows.select(*DEVICE_COLS, *[v.alias(n) for n, v in values.items()], change.alias("_c"), order_of().alias("_o"))
                .groupBy(*DEVICE_COLS, *values)
                .agg(F.max_by("_c", "_o").alias("_c"))
            )
            matched = all_of(F.col(c) == F.col(f"_v{i}") for i, c in enumerate(names))
        else:
            hits = rows.select(*DEVICE_COLS, change.alias("_c"), F.col("_terms").alias("_t"))
            if shape["names"]:
                matched = all_of(
                    _compare(F.col(c), o, _typed(spec, c, F.col("_t")[i]["value"]))
                    for i, (c, o) in enumerate(zip(shape["names"], shape["operators"]))
                )
            else:
                matched = F.expr(shape["predicate"]) if shape["predicate"] else F.lit(True)
        state = _apply_hits(state, broadcast_counted(hits, count), matched, shape, spec)
    return state


def _literal_shape(shape) -> Column:
    def texts(values):
        if values is None:
            return F.lit(None).cast("array<string>")
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return F.struct(
        F.lit(shape["op"]).alias("op"),
        texts(shape["names"]).alias("names"),
        texts(shape["operators"]).alias("operators"),
        texts(shape["assigned"]).alias("assigned"),
        F.lit(shape["predicate"]).cast("string").alias("predicate"),
        F.lit(shape["joinable"]).alias("joinable"),
    )


def _apply_hits(state: DataFrame, hits: DataFrame, matched: Column, shape, spec: TableSpec) -> DataFrame:
    device = {c: f"_h{c}" for c in DEVICE_COLS}
    side = hits.withColumnsRenamed(device)
    same_device = all_of(F.col(c).eqNullSafe(F.col(h)) for c, h in device.items())
    if shape["op"] == DELETE_WHERE:
        return state.join(side, same_device & is_true(matched), "left_anti")
    joined = state.join(side, same_device & is_true(matched), "left")
    hit = F.col("_c").isNotNull()
    changed = {
        c: F.when(hit, _typed(spec, c, F.try_element_at(F.col("_c")["_set"], F.lit(c)))).otherwise(F.col(c))
        for c in shape["assigned"]
    }
    changed["_commit_id"] = F.when(hit, F.col("_c")["_commit_id"]).otherwise(F.col("_commit_id"))
    return joined.withColumns(changed).select(*state.columns)


def fold_with_bulk(
    changes: DataFrame,
    bulk: DataFrame,
    spec: TableSpec,
    ops: Iterable[str] = ROW_OPS,
    state: DataFrame | None = None,
    cut_every: int = 10,
) -> DataFrame:
    """Fold keyed changes and bulk changes of a table in log order.

    The log is read once: one aggregate summarises it per (epoch, key). Rounds
    then join those summaries to the state. Lineage is cut to files every
    ``cut_every`` rounds so that the plan does not grow with the log.
    """
    ops = set(ops)
    shaped = cut_lineage(_shaped(bulk), "bulk")
    runs = cut_lineage(run_starts(shaped), "runs")
    devices, rounds = runs.agg(F.count("*"), F.max(F.size("_runs"))).first()
    rounds = rounds or 0
    if rounds == 0:
        return fold(changes, spec, ops) if state is None else merge(state, changes, spec, ops)
    if TRUNCATE in ops:
        if state is not None:
            state = join_same(state, truncated_devices(changes).select(*DEVICE_COLS), DEVICE_COLS, "left_anti")
        changes = after_truncate(changes)
        ops = ops - {TRUNCATE}
    runs = broadcast_counted(runs, devices)

    def numbered(df: DataFrame, inclusive: bool, name: str) -> DataFrame:
        def earlier(start: Column) -> Column:
            return start <= order_of() if inclusive else start < order_of()

        found = F.when(F.col("_runs").isNull(), 0).otherwise(F.size(F.filter("_runs", earlier)))
        return join_same(df, runs, DEVICE_COLS, "left").withColumn(name, found).drop("_runs")

    summaries = cut_lineage(summarise(numbered(changes, False, "_epoch"), spec, ops, by=("_epoch",)), "epochs")
    steps = numbered(shaped, True, "_run")
    shapes: dict[int, list] = {}
    for row in steps.groupBy("_run", "_shape").count().collect():
        shapes.setdefault(row["_run"], []).append((row["_shape"], row["count"]))
    for number in range(rounds + 1):
        part = summaries.where(F.col("_epoch") == number).drop("_epoch")
        if state is None:
            state = resolve(part, spec)
        else:
            state = apply_summary(before_batch(state, spec), part, spec, False)
        if number < rounds:
            state = apply_run(state, steps.where(F.col("_run") == number + 1), shapes[number + 1], spec)
        if number % cut_every == cut_every - 1:
            state = cut_lineage(state, "state")
    return state
