"""From raw command logs to typed, filtered, mapped change frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions import statements as st
from deltaloom.functions.columns import all_of, is_true, join_same
from deltaloom.model import (
    CHANGE_COLS,
    DELETE,
    DELETE_WHERE,
    DEVICE_COLS,
    INSERT,
    INSERT_IGNORE,
    ORDER_COLS,
    REPLACE,
    TRUNCATE,
    UPDATE,
    UPDATE_WHERE,
    UPSERT,
    TableSpec,
    order_of,
)
from deltaloom.storage import broadcast_checked

LOG_COLS = (*DEVICE_COLS, *ORDER_COLS, "_commit_id", "sql", "args")


# -- C02: published transactions ------------------------------------------------


def expand_transactions(master: DataFrame, txn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replace REPLAY_TXN control rows by the rows of the transaction they publish.

    Returns ``(log, unmatched)``. A control row whose transaction is missing is
    reported, and its device is held back from that position on: applying what
    follows would reorder its commits.
    """
    controls, expanded = _published(master, txn)
    key = [*DEVICE_COLS, "_segment", "_commit_id"]
    published = txn.select(*key).distinct()
    unmatched = join_same(controls, published, key, "left_anti")
    held = unmatched.groupBy(*DEVICE_COLS).agg(
        F.min(F.struct(F.col("_segment"), F.col("_at").alias("_seq"))).alias("_held")
    )
    log = _direct(master).unionByName(expanded)
    ready = (
        join_same(log, held, DEVICE_COLS, "left")
        .where(F.col("_held").isNull() | (F.struct("_segment", "_seq") < F.col("_held")))
        .select(*LOG_COLS)
    )
    return ready, unmatched.withColumnRenamed("_at", "_seq")


def _published(master: DataFrame, txn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Control rows of a log, and the rows of their transactions at the control rows' places."""
    commit = F.coalesce(
        st.piece(F.col("sql"), st.REPLAY_TXN, 1).cast("bigint"),
        F.try_element_at("args", F.lit(1)).cast("string").cast("bigint"),
        F.col("_commit_id"),
    )
    controls = master.where(F.col("sql").rlike(st.REPLAY_TXN)).select(
        *DEVICE_COLS, "_segment", F.col("_seq").alias("_at"), commit.alias("_commit_id")
    )
    rows = join_same(txn.withColumn("_txn_seq", F.col("_seq")).drop("_seq"), controls, [*DEVICE_COLS, "_segment", "_commit_id"])
    return controls, rows.withColumnRenamed("_at", "_seq").select(*LOG_COLS)


def _direct(master: DataFrame) -> DataFrame:
    return master.where(~F.coalesce(F.col("sql").rlike(st.REPLAY_TXN), F.lit(False))).select(*LOG_COLS)


def expand_transaction_stream(master: DataFrame, txn: DataFrame) -> DataFrame:
    """S07, C02 on streams: the log with the rows of published transactions in place of their control rows.

    A stream-stream join: whichever half comes first, control row or transaction, is kept as state until the other comes, so files may come in
    any order and a restart goes on with what waits. Rows carry their place in the log; a transaction that comes late comes after rows
    that stand behind it, so whoever applies the stream sorts by place or holds a device with an open control row back.
    """
    return _direct(master).unionByName(_published(master, txn)[1])


# -- C03 / C04: statements to typed changes ----------------------------------------


def _lookup(table: Column, entries: Mapping[str, Iterable[str]]) -> Column:
    """Array of names for a table, from a driver-side spec of known tables."""
    found = F.lit(None).cast("array<string>")
    for name, columns in entries.items():
        found = F.when(F.lower(table) == name.lower(), F.array(*[F.lit(c) for c in columns])).otherwise(found)
    return found


def _statement_parts(sql: Column) -> dict[str, Column]:
    """Groups of the row-statement shapes; each is tried only on its own verb."""
    return {
        "I": st.groups(sql, st.INSERT_INTO, 5, st.starts_with(sql, "INSERT", "REPLAC", "UPSERT")),
        "U": st.groups(sql, st.UPDATE_SET, 3, st.starts_with(sql, "UPDATE")),
        "D": st.groups(sql, st.DELETE_FROM, 2, st.starts_with(sql, "DELETE")),
        "T": F.when(st.starts_with(sql, "TRUNCA"), st.piece(sql, st.TRUNCATE_TABLE, 1)),
    }


def statement_table(sql: Column) -> Column:
    """Table a row statement writes to."""
    return F.nullif(F.regexp_extract(sql, st.WRITTEN_TABLE, 1), F.lit(""))


#: Rows of one statement, at most; places inside a transaction are that far apart afterwards.
STATEMENT_ROWS = 1 << 20


def split_rows(log: DataFrame) -> DataFrame:
    """One log row per row of values: ``VALUES (...), (...)`` becomes as many statements, each with the arguments its marks take.

    They follow each other by ``_txn_seq``. Statements with anything but literals and marks in their values stay as they are.
    """
    sql = F.col("sql")
    many = F.coalesce(sql.rlike(r"\)\s*,\s*\("), F.lit(False))
    # one match per statement, and none of three others for those that have one row
    odd = sql.contains(st.SEPARATOR)
    log_columns, log = log.columns, log.withColumn("_found", st.groups(sql, st.MANY_ROWS, 3, many & ~odd))

    def cut_out(group: int) -> Column:
        return F.when(odd, F.when(many, st.piece(sql, st.MANY_ROWS, group))).otherwise(st.part(F.col("_found"), group))

    rows = st.pieces(cut_out(2), "(" + st.TUPLE + ")", 1)
    marks = F.transform("_rows", lambda r: st.marks_in(st.pieces(r, r"('[^']*+'|\?)", 1)))
    cut = log.withColumn("_rows", rows).withColumn("_marks", marks)
    each = F.when(F.col("_rows").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size("_rows") - 1))
    cut = cut.withColumn("_nth", F.explode(each))
    before = F.aggregate(F.slice("_marks", F.lit(1), F.col("_nth")), F.lit(0), lambda s, m: s + m)
    text = F.concat(cut_out(1), F.lit(" "), F.get("_rows", "_nth"), F.lit(" "), F.coalesce(cut_out(3), F.lit("")))
    changed = {
        "args": F.when(F.col("_rows").isNotNull(), F.slice("args", before + 1, F.get("_marks", "_nth"))).otherwise(F.col("args")),
        "_txn_seq": F.col("_txn_seq") * STATEMENT_ROWS + F.col("_nth"),
        "sql": F.when(F.col("_rows").isNotNull(), text).otherwise(sql),
    }
    return cut.withColumns(changed).select(*log_columns)


def deduce_changes(log: DataFrame, specs: Iterable[TableSpec] = ()) -> DataFrame:
    """Statement text -> operation, table and column/value maps.

    Adds ``_table``, ``_op``, ``_set`` and ``_where`` (column -> binary value),
    ``_terms`` (a WHERE made of comparisons), ``_predicate`` (text of any other
    WHERE), and ``_problem`` for rows that could not be deduced. Columns and
    keys of a table come from ``specs``, or per row from ``_known_columns`` and
    ``_known_keys`` (see :func:`deltaloom.operators.evolve.with_known_schema`).
    The work is per row: no join on statement texts, which would be as skewed
    as the statements are.
    """
    specs = list(specs)
    log = split_rows(log)
    if "_known_columns" not in log.columns:
        table = statement_table(F.col("sql"))
        log = log.withColumns(
            {
                "_known_columns": _lookup(table, {s.name: s.columns for s in specs}),
                "_known_keys": _lookup(table, {s.name: s.keys for s in specs}),
            }
        )
    matched = log.select(
        *LOG_COLS, "_known_columns", "_known_keys", *[c.alias(f"_{n}") for n, c in _statement_parts(F.col("sql")).items()]
    )
    insert, update, delete = F.col("_I"), F.col("_U"), F.col("_D")
    shaped = matched.select(
        *LOG_COLS,
        "_known_columns",
        "_known_keys",
        F.coalesce(st.part(insert, 2), st.part(update, 1), st.part(delete, 1), F.col("_T")).alias("_table"),
        st.part(insert, 1).alias("_verb"),
        st.part(insert, 5).alias("_conflict"),
        st.part(insert, 3).alias("_names"),
        st.part(insert, 4).alias("_values"),
        st.part(update, 2).alias("_assign"),
        F.coalesce(st.part(update, 3), st.part(delete, 2)).alias("_condition"),
        F.when(st.matched(insert), "I")
        .when(st.matched(update), "U")
        .when(st.matched(delete), "D")
        .when(F.col("_T").isNotNull(), "T")
        .alias("_kind"),
    )
    tokens_set = F.when(F.col("_kind") == "I", st.pieces(F.col("_values"), "(" + st.LITERAL + ")", 1)).when(
        F.col("_kind") == "U", st.pieces(F.col("_assign"), st.PAIR, 2)
    )
    names_set = F.when(
        F.col("_kind") == "I",
        F.when(F.col("_names").isNotNull(), st.names(F.col("_names"))).otherwise(F.col("_known_columns")),
    ).when(F.col("_kind") == "U", st.pieces(F.col("_assign"), st.PAIR, 1))
    equalities = F.col("_condition").rlike(st.EQUALITIES)
    comparisons = F.col("_condition").rlike(st.COMPARISONS)
    cut = shaped.select(
        *LOG_COLS,
        "_table",
        "_kind",
        "_verb",
        "_conflict",
        "_condition",
        tokens_set.alias("_set_tokens"),
        names_set.alias("_set_names"),
        F.when(comparisons, st.pieces(F.col("_condition"), st.TERM, 3)).alias("_where_tokens"),
        F.when(comparisons, st.pieces(F.col("_condition"), st.TERM, 2)).alias("_where_operators"),
        F.when(comparisons, st.pieces(F.col("_condition"), st.TERM, 1)).alias("_where_names"),
        F.coalesce(equalities, F.lit(False)).alias("_equalities"),
        "_known_columns",
        F.col("_known_keys").alias("_keys"),
        F.coalesce(
            F.when(F.col("_kind") == "I", F.col("_values").rlike(st.VALUE_LIST)),
            F.when(F.col("_kind") == "U", F.col("_assign").rlike(st.SET_LIST)),
            F.col("_kind").isNotNull(),
        ).alias("_plain"),
    )
    keyed = F.col("_equalities") & (F.size("_keys") > 0) & (F.sort_array("_where_names") == F.sort_array("_keys"))
    verb = F.upper(F.regexp_replace("_verb", r"\s+", " "))
    ignores = (verb == "INSERT OR IGNORE") | F.coalesce(F.col("_conflict").rlike(r"(?i)\bDO\s+NOTHING"), F.lit(False))
    op = (
        F.when((F.col("_kind") == "I") & ignores, INSERT_IGNORE)
        .when((F.col("_kind") == "I") & (F.col("_conflict").isNotNull() | (verb == "UPSERT")), UPSERT)
        .when((F.col("_kind") == "I") & verb.isin("REPLACE", "INSERT OR REPLACE"), REPLACE)
        .when(F.col("_kind") == "I", INSERT)
        .when((F.col("_kind") == "T") | ((F.col("_kind") == "D") & F.col("_condition").isNull()), TRUNCATE)
        .when(F.col("_kind") == "U", F.when(F.coalesce(keyed, F.lit(False)), UPDATE).otherwise(UPDATE_WHERE))
        .when(F.col("_kind") == "D", F.when(F.coalesce(keyed, F.lit(False)), DELETE).otherwise(DELETE_WHERE))
    )
    moves_key = (F.col("_kind") == "U") & F.arrays_overlap("_set_names", "_keys")
    problem = (
        F.when(F.col("_kind").isNull(), "statement shape not recognised")
        .when(F.col("_known_columns").isNull(), "unknown table")
        .when(~F.col("_plain"), "assigned values are expressions")
        .when(
            (F.col("_kind") == "I") & (F.size("_set_names") != F.size("_set_tokens")),
            "column and value counts differ",
        )
        .when(moves_key, "key-changing update with a partial image")
        .when(
            F.col("_where_names").isNull() & F.col("_condition").contains("?"),
            "condition with bound values is not a list of comparisons",
        )
    )
    where_values = st.bound_values(F.col("_where_tokens"), F.col("args"), st.marks_in(F.col("_set_tokens")))
    none = F.lit(None).cast("map<string,binary>")
    return cut.select(
        *LOG_COLS,
        "_table",
        F.when(problem.isNull(), op).alias("_op"),
        F.when(
            problem.isNull() & F.col("_kind").isin("I", "U"),
            F.map_from_arrays("_set_names", st.bound_values(F.col("_set_tokens"), F.col("args"), F.lit(0))),
        )
        .otherwise(none)
        .alias("_set"),
        F.when(problem.isNull() & F.col("_equalities"), F.map_from_arrays("_where_names", where_values))
        .otherwise(none)
        .alias("_where"),
        F.when(
            problem.isNull() & F.col("_where_names").isNotNull(),
            F.arrays_zip(
                F.col("_where_names").alias("column"),
                F.col("_where_operators").alias("operator"),
                where_values.alias("value"),
            ),
        ).alias("_terms"),
        F.when(F.col("_where_names").isNull(), F.col("_condition")).alias("_predicate"),
        problem.alias("_problem"),
    )


def unrecognised(deduced: DataFrame) -> DataFrame:
    """Report of log rows that did not become changes; DDL rows are handled elsewhere."""
    ddl = F.col("sql").rlike(r"(?i)^\s*(CREATE|ALTER|DROP)\s+TABLE\b")
    return deduced.where(F.col("_problem").isNotNull() & ~is_true(ddl)).select(
        *DEVICE_COLS, *ORDER_COLS, "sql", "_problem"
    )


def bound_cast(value: Column, dtype: T.DataType) -> Column:
    """Bound value (bytes) -> declared type. Text stays exact; numbers are tried."""
    if isinstance(dtype, T.BinaryType):
        return value
    text = value.cast("string")
    return text if isinstance(dtype, T.StringType) else text.try_cast(dtype)


def bind(deduced: DataFrame, spec: TableSpec) -> DataFrame:
    """One table's deduced rows -> typed change frame.

    SET and WHERE stay separate maps: a column may appear in both.
    """
    rows = deduced.where((F.lower("_table") == spec.name.lower()) & F.col("_op").isNotNull())

    def value(field: T.StructField) -> Column:
        assigned = F.try_element_at("_set", F.lit(field.name))
        if field.name in spec.keys:
            assigned = F.coalesce(assigned, F.try_element_at("_where", F.lit(field.name)))
        return bound_cast(assigned, field.dataType).alias(field.name)

    return rows.select(
        *DEVICE_COLS,
        *ORDER_COLS,
        "_commit_id",
        "_op",
        F.map_keys("_set").alias("_set_cols"),
        *[value(f) for f in spec.schema.fields],
    )


# -- C06-C09: which changes count ---------------------------------------------------


def committed_only(changes: DataFrame, txn: DataFrame, single_writer: DataFrame | None = None) -> DataFrame:
    """Keep changes whose commit was recorded; rolled-back work never arrives.

    A multi-writer device records every commit. The devices in ``single_writer``
    (``_device_id``) keep one row and overwrite it: all their commits up to that
    one were recorded, as such a device commits in order.
    """
    key = ["_device_id", "_commit_id"]
    if single_writer is None:
        return join_same(changes, txn.select(*key), key, "left_semi").select(*changes.columns)
    singles = broadcast_checked(single_writer.select(F.col("_device_id").alias("_single")).distinct())
    mine = F.col("_device_id").eqNullSafe(F.col("_single"))
    listed = join_same(changes.join(singles, mine, "left_anti"), txn.select(*key), key, "left_semi").select(*changes.columns)
    last = txn.groupBy(F.col("_device_id").alias("_single")).agg(F.max("_commit_id").alias("_last"))
    upto = broadcast_checked(join_same(last, singles, ["_single"], "left_semi"))
    ordered = changes.join(upto, mine).where(F.col("_commit_id") <= F.col("_last")).select(*changes.columns)
    return listed.unionByName(ordered)


def drop_redelivered(changes: DataFrame) -> DataFrame:
    """One copy of each log row (the fold does not need this, counts do)."""
    return changes.dropDuplicates([*DEVICE_COLS, *ORDER_COLS])


def after_marks(changes: DataFrame, marks: DataFrame) -> DataFrame:
    """Keep changes above the device's applied position.

    ``marks`` has one row per device: ``_device_id, _device_name, _applied``
    (a struct as built by :func:`~deltaloom.model.order_of`).
    """
    marked = broadcast_checked(marks.select(*DEVICE_COLS, "_applied"))
    return (
        join_same(changes, marked, DEVICE_COLS, "left")
        .where(F.col("_applied").isNull() | (order_of() > F.col("_applied")))
        .select(*changes.columns)
    )


def hold_gaps(changes: DataFrame, marks: DataFrame, first_segment: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(ready, held)``. A device is held back from its first missing segment on.

    ``first_segment`` is where devices without a mark begin; a late first segment is a gap like any other.
    Works on the distinct (device, segment) pairs, not on the rows.
    """
    segments = changes.select(*DEVICE_COLS, "_segment").distinct()
    reached = marks.select(*DEVICE_COLS, F.col("_applied")["_segment"].alias("_done"))
    ahead = join_same(segments, reached, DEVICE_COLS, "left").withColumn("_done", F.coalesce("_done", F.lit(first_segment - 1)))
    nth = F.row_number().over(Window.partitionBy(*DEVICE_COLS).orderBy("_segment"))
    # segments at or below the mark may be re-delivered; the mark's own may go on
    new = ahead.where(F.col("_segment") > F.col("_done")).withColumn("_nth", nth)
    missing = new.where(F.col("_segment") != F.col("_done") + F.col("_nth"))
    first = missing.groupBy(*DEVICE_COLS).agg(F.min("_segment").alias("_gap"))
    marked = join_same(changes, first, DEVICE_COLS, "left")
    waits = F.col("_gap").isNotNull() & (F.col("_segment") >= F.col("_gap"))
    return marked.where(~waits).select(*changes.columns), marked.where(waits).select(*changes.columns)


def high_marks(changes: DataFrame) -> DataFrame:
    """Applied position and commit per device once ``changes`` are in."""
    return changes.groupBy(*DEVICE_COLS).agg(
        F.max(order_of()).alias("_applied"), F.max("_commit_id").alias("_applied_commit")
    )


def only_tables(
    changes: DataFrame, include: Iterable[str] = (), exclude: Iterable[str] = (), column: str = "_table"
) -> DataFrame:
    """Include / exclude lists; a table on both is excluded."""
    include, exclude = list(include), list(exclude)
    if include:
        changes = changes.where(F.col(column).isin(include))
    if exclude:
        changes = changes.where(~F.col(column).isin(exclude))
    return changes


# -- C11-C14: columns, values, types --------------------------------------------------


def map_columns(changes: DataFrame, rename: Mapping[str, str], skip: Iterable[str] = ()) -> DataFrame:
    """C11: rename or skip columns, in the data and in the list of assigned columns."""
    skip = [c for c in skip if c in changes.columns]
    renamed = changes.drop(*skip).withColumnsRenamed(dict(rename))
    if "_set_cols" not in changes.columns:
        return renamed
    named = F.col("_set_cols")
    if skip:
        named = F.filter(named, lambda c: ~c.isin(skip))
    if rename:
        pairs = F.create_map(*[F.lit(x) for pair in rename.items() for x in pair])
        named = F.transform(named, lambda c: F.coalesce(F.try_element_at(pairs, c), c))
    return renamed.withColumn("_set_cols", named)


def keep_rows(folded: DataFrame, predicate: str | Column) -> DataFrame:
    """Row filter on folded rows (a partial change may lack the filtered column)."""
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    return folded.where(is_true(condition))


def filter_changes(reported: DataFrame, spec: TableSpec, predicate: str) -> DataFrame:
    """C12 as changes: touched rows that match become upserts, the others deletes."""
    matches = is_true(F.expr(predicate)) & (F.col("_effect") != "deleted")
    return reported.where(F.col("_effect").isin("inserted", "updated", "deleted")).select(
        *DEVICE_COLS,
        "_commit_id",
        F.when(matches, F.lit(REPLACE)).otherwise(F.lit(DELETE)).alias("_op"),
        *[F.col(c) if c in spec.keys else F.when(matches, F.col(c)).alias(c) for c in spec.columns],
    )


def map_types(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Cast columns; returns ``(accepted, rejected)``, rejects with the reasons."""
    failed = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in types.items()
    ]
    checked = df.withColumn("_failed", F.array_compact(F.array(*failed)))
    accepted = checked.where(F.size("_failed") == 0).select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )
    return accepted, checked.where(F.size("_failed") > 0)


def only_columns(df: DataFrame, include: Iterable[str] = (), exclude: Iterable[str] = ()) -> DataFrame:
    """C14: column filter at the source; pruning reaches the scan."""
    include, exclude = set(include) or set(df.columns), set(exclude)
    return df.select(*[c for c in df.columns if c in CHANGE_COLS or (c in include and c not in exclude)])


def key_is_set(spec: TableSpec) -> Column:
    return all_of(F.col(k).isNotNull() for k in spec.keys)
