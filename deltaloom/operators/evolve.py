"""Schema changes as part of the log.

Every column a device creates gets an id that survives renames; a column that
is dropped and added again gets a new one. Each device's DDL history is turned
into epochs: from which log position to which its table had which columns, and
where each of them ended up. A change row is joined to its epoch and its
columns are moved to their final names *before* the fold, so a log with any
number of DDL statements is still folded once.

Replication follows the device: renames and drops take effect. Consolidation
shares the table: columns and tables are only ever added, the rest is reported.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions import statements as st
from deltaloom.model import (
    CHANGE_COLS,
    DEVICE_COLS,
    INSERT,
    INSERT_IGNORE,
    ORDER_COLS,
    REPLACE,
    TableSpec,
    common_type,
    declared_type,
    order_of,
)
from deltaloom.operators.normalize import statement_table
from deltaloom.storage import broadcast_checked, cut_lineage

CREATE_TABLE, DROP_TABLE, RENAME_TABLE = "CREATE_TABLE", "DROP_TABLE", "RENAME_TABLE"
ADD_COLUMN, DROP_COLUMN = "ADD_COLUMN", "DROP_COLUMN"
RENAME_COLUMN, WIDEN_COLUMN = "RENAME_COLUMN", "WIDEN_COLUMN"

REPLICATION, CONSOLIDATION = "REPLICATION", "CONSOLIDATION"

DDL_COLS = (*DEVICE_COLS, *ORDER_COLS, "_commit_id", "_table", "_op", "_column", "_type", "_to", "_columns", "_keys", "_defaults")

_ORDER_TYPE = "struct<_segment:bigint,_seq:bigint,_txn_seq:bigint>"
HISTORY_SCHEMA = (
    "_device_id string, _device_name string, _source string, _from " + _ORDER_TYPE + ", _until " + _ORDER_TYPE + ","
    " _target string, _columns array<struct<source:string,target:string,type:string,is_key:boolean,position:int>>,"
    " _defaults map<string,string>"
)


def read_ddl(log: DataFrame) -> DataFrame:
    """DDL rows of a command log, taken apart."""
    sql = F.col("sql")
    kinds = {
        CREATE_TABLE: st.CREATE_TABLE,
        RENAME_COLUMN: st.RENAME_COLUMN,
        RENAME_TABLE: st.RENAME_TABLE,
        DROP_TABLE: st.DROP_TABLE,
        ADD_COLUMN: st.ADD_COLUMN,
        WIDEN_COLUMN: st.WIDEN_COLUMN,
        DROP_COLUMN: st.DROP_COLUMN,
    }
    op = F.lit(None).cast("string")
    for name, pattern in reversed(kinds.items()):
        op = F.when(sql.rlike(pattern), name).otherwise(op)
    whole = st.piece(sql, st.CREATE_TABLE, 2)
    body = F.regexp_replace(whole, st.TEXT_LITERAL, "''")  # commas and words inside a default are no columns
    column = F.coalesce(*[st.piece(sql, p, 2) for p in (st.ADD_COLUMN, st.WIDEN_COLUMN, st.RENAME_COLUMN, st.DROP_COLUMN)])
    defined = F.arrays_zip(
        st.pieces(body, st.COLUMN_DEF, 1).alias("name"), st.pieces(body, st.COLUMN_DEF, 2).alias("type")
    )
    keys = F.concat(st.pieces(body, st.INLINE_KEY, 1), F.coalesce(st.names(st.piece(body, st.TABLE_KEY, 1)), F.array()))
    added = F.create_map(st.piece(sql, st.ADD_DEFAULT, 2), st.piece(sql, st.ADD_DEFAULT, 3))
    created = F.map_from_arrays(st.pieces(whole, st.COLUMN_DEFAULT, 1), st.pieces(whole, st.COLUMN_DEFAULT, 2))
    defaults = F.when(sql.rlike(st.ADD_DEFAULT), added).when(op == CREATE_TABLE, created)
    return (
        log.where(sql.rlike(r"(?i)^\s*(CREATE|ALTER|DROP)\s+TABLE\b"))
        .select(
            *DEVICE_COLS,
            *ORDER_COLS,
            "_commit_id",
            F.coalesce(*[st.piece(sql, p, 1) for p in kinds.values()]).alias("_table"),
            op.alias("_op"),
            F.when(op.isin(ADD_COLUMN, WIDEN_COLUMN, RENAME_COLUMN, DROP_COLUMN), column).alias("_column"),
            F.coalesce(st.piece(sql, st.ADD_COLUMN, 3), st.piece(sql, st.WIDEN_COLUMN, 3)).alias("_type"),
            F.coalesce(st.piece(sql, st.RENAME_COLUMN, 3), st.piece(sql, st.RENAME_TABLE, 2)).alias("_to"),
            F.when(op == CREATE_TABLE, defined).alias("_columns"),
            F.when(op == CREATE_TABLE, keys).alias("_keys"),
            defaults.alias("_defaults"),
        )
        .dropDuplicates([*DEVICE_COLS, *ORDER_COLS])
    )


def ddl_rows(
    df: DataFrame,
    *,
    device_id: Column,
    device_name: Column,
    segment: Column,
    seq: Column,
    commit_id: Column,
    table: Column,
    op: Column,
    column: Column | None = None,
    dtype: Column | None = None,
    to: Column | None = None,
    columns: Mapping[str, str] | None = None,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """DDL frame from a frame with one row per schema change."""
    none = F.lit(None).cast("string")
    defined = (
        F.array(*[F.struct(F.lit(c).alias("name"), F.lit(t).alias("type")) for c, t in columns.items()])
        if columns
        else F.lit(None).cast("array<struct<name:string,type:string>>")
    )
    key_list = F.array(*[F.lit(k) for k in keys]) if keys else F.lit(None)
    return df.select(
        device_id.cast("string").alias("_device_id"),
        device_name.cast("string").alias("_device_name"),
        segment.cast("bigint").alias("_segment"),
        seq.cast("bigint").alias("_seq"),
        F.lit(0).cast("bigint").alias("_txn_seq"),
        commit_id.cast("bigint").alias("_commit_id"),
        table.cast("string").alias("_table"),
        op.cast("string").alias("_op"),
        (column if column is not None else none).cast("string").alias("_column"),
        (dtype if dtype is not None else none).cast("string").alias("_type"),
        (to if to is not None else none).cast("string").alias("_to"),
        F.when(op == CREATE_TABLE, defined).alias("_columns"),
        F.when(op == CREATE_TABLE, key_list.cast("array<string>")).alias("_keys"),
        F.lit(None).cast("map<string,string>").alias("_defaults"),
    )


def _spark_type(name: str | None) -> str:
    return declared_type(name or "TEXT").simpleString()


def _default_value(literal: str | None) -> str | None:
    """The value of a literal as text; null for NULL and for bytes."""
    if literal is None or literal[:2].upper() == "X'" or literal.upper() == "NULL":
        return None
    if literal.startswith("'"):
        return literal[1:-1].replace("''", "'")
    return {"TRUE": "1", "FALSE": "0"}.get(literal.upper(), literal)


def _device_history(events: pd.DataFrame, mode: str) -> list[dict]:
    """Epochs of one device. DDL rows of one device are few: it is their schema history."""
    tables: dict[str, dict[str, int]] = {}  # live table name -> {column name: column id}
    lives: dict[str, int] = {}  # live table name -> table id
    columns: list[dict] = []  # column id -> final name, type, key flag, table id
    final_table: dict[int, str | None] = {}
    open_epochs: dict[str, dict] = {}
    closed: list[dict] = []

    def new_column(name: str, dtype: str, is_key: bool, life: int, default: str | None) -> int:
        known = {"name": name, "type": dtype, "is_key": is_key, "position": len(columns)}
        columns.append(known | {"born": name, "life": life, "default": _default_value(default)})
        return len(columns) - 1

    def close(name: str, at) -> None:
        epoch = open_epochs.pop(name, None)
        if epoch is not None:
            epoch["until"] = at
            closed.append(epoch)

    def begin(name: str, at) -> None:
        close(name, at)
        open_epochs[name] = {"source": name, "from": at, "until": None, "life": lives[name], "ids": dict(tables[name])}

    for event in events.sort_values(list(ORDER_COLS)).to_dict("records"):
        at = tuple(int(event[c]) for c in ORDER_COLS)
        name, op, column = event["_table"], event["_op"], event["_column"]
        defaults = dict(event["_defaults"]) if event["_defaults"] is not None else {}
        if op == CREATE_TABLE and name not in tables:
            life = len(final_table)
            final_table[life] = name
            lives[name] = life
            keys = set(event["_keys"]) if event["_keys"] is not None else set()
            tables[name] = {
                c["name"]: new_column(c["name"], _spark_type(c["type"]), c["name"] in keys, life, defaults.get(c["name"])) for c in event["_columns"]
            }
            begin(name, at)
        elif name not in tables:
            continue
        elif op == ADD_COLUMN and column not in tables[name]:
            tables[name][column] = new_column(column, _spark_type(event["_type"]), False, lives[name], defaults.get(column))
            begin(name, at)
        elif op == RENAME_COLUMN and column in tables[name]:
            # dict rebuilt so that the column keeps its place
            tables[name] = {event["_to"] if c == column else c: i for c, i in tables[name].items()}
            columns[tables[name][event["_to"]]]["name"] = event["_to"]
            begin(name, at)
        elif op == DROP_COLUMN and column in tables[name]:
            columns[tables[name].pop(column)]["name"] = None
            begin(name, at)
        elif op == WIDEN_COLUMN and column in tables[name]:
            known = columns[tables[name][column]]
            known["type"] = common_type(known["type"], _spark_type(event["_type"])) or known["type"]
        elif op == RENAME_TABLE:
            close(name, at)
            tables[event["_to"]], lives[event["_to"]] = tables.pop(name), lives.pop(name)
            final_table[lives[event["_to"]]] = event["_to"]
            begin(event["_to"], at)
        elif op == DROP_TABLE:
            close(name, at)
            tables.pop(name)
            final_table[lives.pop(name)] = None
    closed += open_epochs.values()

    follow = mode == REPLICATION
    rows = []
    for epoch in closed:
        target = final_table[epoch["life"]] if follow else epoch["source"]
        entries = []
        for source, i in epoch["ids"].items():
            final = columns[i]["name"] if follow else source
            entries.append(
                {
                    "source": source,
                    "target": final,
                    "type": columns[i]["type"],
                    "is_key": columns[i]["is_key"],
                    "position": columns[i]["position"],
                }
            )
        # a default is filled into rows older than its column, so all epochs of a table have it
        mine = [c for c in columns if c["life"] == epoch["life"] and c["default"] is not None]
        defaults = {c["name"] if follow else c["born"]: c["default"] for c in mine if c["name"] is not None or not follow}
        rows.append({"source": epoch["source"], "from": epoch["from"], "until": epoch["until"], "target": target, "columns": entries, "defaults": defaults})
    return rows


def schema_histories(ddl: DataFrame, mode: str) -> DataFrame:
    """Epochs per device and table; see the module text.

    Written out once: the steps that follow read it several times.
    """

    def per_device(events: pd.DataFrame) -> pd.DataFrame:
        def place(at):
            return None if at is None else dict(zip(ORDER_COLS, at))

        found = _device_history(events, mode)
        return pd.DataFrame(
            {
                "_device_id": [events["_device_id"].iloc[0]] * len(found),
                "_device_name": [events["_device_name"].iloc[0]] * len(found),
                "_source": [r["source"] for r in found],
                "_from": [place(r["from"]) for r in found],
                "_until": [place(r["until"]) for r in found],
                "_target": [r["target"] for r in found],
                "_columns": [r["columns"] for r in found],
                "_defaults": [r["defaults"] for r in found],
            }
        )

    found = ddl.select(*DDL_COLS).groupBy(*DEVICE_COLS).applyInPandas(per_device, HISTORY_SCHEMA)
    return cut_lineage(found, "histories")


def _in_epoch() -> Column:
    return (order_of() >= F.col("_from")) & (F.col("_until").isNull() | (order_of() < F.col("_until")))


def with_known_schema(log: DataFrame, histories: DataFrame) -> DataFrame:
    """Add the columns and keys the written table had at each log row."""
    epochs = broadcast_checked(
        histories.select(
            *DEVICE_COLS,
            F.lower("_source").alias("_t"),
            "_from",
            "_until",
            F.transform("_columns", lambda c: c["source"]).alias("_known_columns"),
            F.transform(F.filter("_columns", lambda c: c["is_key"]), lambda c: c["source"]).alias("_known_keys"),
        )
    )
    rows = log.withColumn("_t", F.lower(statement_table(F.col("sql"))))
    joined = rows.alias("l").join(
        epochs.alias("e"),
        F.col("l._device_id").eqNullSafe(F.col("e._device_id"))
        & F.col("l._device_name").eqNullSafe(F.col("e._device_name"))
        & (F.col("l._t") == F.col("e._t"))
        & _in_epoch(),
        "left",
    )
    return joined.select("l.*", "_known_columns", "_known_keys").drop("_t")


def target_spec(histories: DataFrame, table: str, replicated: bool) -> TableSpec:
    """Final schema of a destination table: union over devices, widest types.

    Reads back one row per distinct column, not data. In replication only the
    epochs that are still open count; in consolidation every column ever added.
    """
    epochs = histories.where(F.col("_target") == table)
    if replicated:
        epochs = epochs.where(F.col("_until").isNull())
    found = (
        epochs.select(F.explode("_columns").alias("c"))
        .select("c.*")
        .where(F.col("target").isNotNull())
        .groupBy("target", "type", "is_key")
        .agg(F.min("position").alias("position"))
        .orderBy("position", "target", "type")
        .collect()
    )
    types: dict[str, str] = {}
    keys: list[str] = []
    for row in found:
        known = types.get(row["target"])
        types[row["target"]] = row["type"] if known is None else (common_type(known, row["type"]) or known)
        if row["is_key"] and row["target"] not in keys:
            keys.append(row["target"])
    schema = T.StructType([T.StructField(c, T._parse_datatype_string(t)) for c, t in types.items()])
    return TableSpec(table, schema, tuple(keys))


def source_columns(histories: DataFrame, table: str) -> list[tuple[str, str]]:
    """Distinct (name in the log, final name) pairs of a destination table."""
    rows = (
        histories.where(F.col("_target") == table)
        .select(F.explode("_columns").alias("c"))
        .select("c.source", "c.target")
        .where(F.col("target").isNotNull())
        .distinct()
        .collect()
    )
    return sorted((r["source"], r["target"]) for r in rows)


def defaulted_columns(histories: DataFrame, table: str) -> set[str]:
    """Final names of a destination table's columns with a default; read back like the columns themselves."""
    rows = histories.where(F.col("_target") == table).select(F.explode(F.map_keys("_defaults")).alias("c")).distinct().collect()
    return {r["c"] for r in rows}


def _with_moves(rows: DataFrame, histories: DataFrame, spec: TableSpec) -> DataFrame:
    """Join rows to their epoch; ``_moved`` maps names of the time to final names."""
    epochs = broadcast_checked(
        histories.where(F.col("_target") == spec.name).select(
            *[F.col(c).alias(f"_e{c}") for c in DEVICE_COLS],
            F.lower("_source").alias("_e_source"),
            "_from",
            "_until",
            F.map_from_entries(
                F.transform(
                    F.filter("_columns", lambda c: c["target"].isNotNull()),
                    lambda c: F.struct(c["source"], c["target"]),
                )
            ).alias("_moved"),
            "_defaults",
        )
    )
    return rows.join(
        epochs,
        F.col("_device_id").eqNullSafe(F.col("_e_device_id"))
        & F.col("_device_name").eqNullSafe(F.col("_e_device_name"))
        & (F.lower("_table") == F.col("_e_source"))
        & _in_epoch(),
    )


def move_columns(changes: DataFrame, histories: DataFrame, spec: TableSpec) -> DataFrame:
    """Change rows under their names of the time -> change frame of the final table.

    ``changes`` needs ``_table`` and any of the source columns. Rows whose table
    was dropped later, and columns that were, fall away here. A row inserted before a column was there, or without naming it, gets the
    column's default.
    """
    joined = _with_moves(changes, histories, spec)
    pairs = [(s, t) for s, t in source_columns(histories, spec.name) if s in changes.columns]
    defaulted = sorted(defaulted_columns(histories, spec.name) & set(spec.values))
    given = F.array_compact(F.transform("_set_cols", lambda c: F.try_element_at("_moved", c)))
    joined = joined.withColumn("_named", F.when(F.col("_set_cols").isNull(), F.map_values("_moved")).otherwise(given))

    def lacks(column: str) -> Column:
        return F.col("_op").isin(INSERT, INSERT_IGNORE, REPLACE) & ~F.array_contains("_named", F.lit(column)) & F.map_contains_key("_defaults", F.lit(column))

    def value(field: T.StructField) -> Column:
        sources = [s for s, t in pairs if t == field.name]
        arms = [F.when(F.try_element_at("_moved", F.lit(s)) == field.name, F.col(s).cast(field.dataType)) for s in sources]
        own = (F.coalesce(*arms) if arms else F.lit(None)).cast(field.dataType)
        if field.name in defaulted:
            own = F.when(lacks(field.name), F.try_element_at("_defaults", F.lit(field.name)).try_cast(field.dataType)).otherwise(own)
        return own.alias(field.name)

    filled = [F.when(lacks(c), F.lit(c)) for c in defaulted]
    named = F.when(F.col("_set_cols").isNotNull(), F.concat(given, F.array_compact(F.array(*filled))) if filled else given)
    return joined.select(
        *[c for c in CHANGE_COLS if c != "_set_cols"],
        named.alias("_set_cols"),
        *[value(f) for f in spec.schema.fields],
    )


def move_bulk(bulk: DataFrame, histories: DataFrame, spec: TableSpec) -> DataFrame:
    """The same for bulk changes: columns of terms and assignments are renamed."""
    joined = _with_moves(bulk, histories, spec)
    terms = F.transform("_terms", lambda t: t.withField("column", F.try_element_at("_moved", t["column"])))
    kept = F.map_filter("_set", lambda k, v: F.map_contains_key("_moved", k))
    return joined.withColumn("_terms", terms).withColumn(
        "_set", F.transform_keys(kept, lambda k, v: F.try_element_at("_moved", k))
    ).select(*[c for c in bulk.columns if c != "_table"])


def ignored_ddl(ddl: DataFrame) -> DataFrame:
    """DDL a consolidated destination does not carry out, with the reason."""
    reason = (
        F.when(F.col("_op") == DROP_TABLE, "table is shared by all devices")
        .when(F.col("_op") == DROP_COLUMN, "column is shared by all devices")
        .when(F.col("_op").isNull(), "statement shape not recognised")
    )
    return (
        ddl.withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("_device_id", F.col("_table").alias("table_name"), F.col("_op").alias("op"), "reason", "_commit_id")
    )


# -- typed frames without a command log (Store / Stream devices) -----------------------


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Union by name; missing columns are null, types are widened."""
    types: dict[str, str] = {}
    for df in frames:
        for field in df.schema.fields:
            name, dtype = field.name, field.dataType.simpleString()
            merged = dtype if name not in types else common_type(types[name], dtype)
            if merged is None:
                raise ValueError(f"column {name}: {types[name]} and {dtype} have no common type")
            types[name] = merged
    aligned = [
        df.select(*[F.col(c).cast(types[c]).alias(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in types])
        for df in frames
    ]
    result = aligned[0]
    for df in aligned[1:]:
        result = result.unionAll(df)
    return result


#: JSON fields that become columns of their own, at most.
JSON_COLUMNS = 1000


def json_columns(df: DataFrame, column: str, most: int = JSON_COLUMNS) -> tuple[list[str], bool]:
    """The most frequent field names of a JSON column, by name, and whether there are more. Only ``most`` names leave the cluster."""
    keys = df.select(F.explode(F.json_object_keys(column)).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    found = [r["k"] for r in keys.orderBy(F.desc("n"), "k").limit(most + 1).collect()]
    return sorted(found[:most]), len(found) > most


def add_json_columns(
    df: DataFrame, column: str, types: Mapping[str, str] | None = None, most: int = JSON_COLUMNS, rest: str = "_rest"
) -> DataFrame:
    """One column per JSON field ever seen; overrides give types.

    Beyond ``most`` fields the less frequent ones stay in the column ``rest``, the parsed object as a VARIANT, so a table of events with
    a hundred thousand field names keeps a readable schema and loses nothing. Fields with a type in ``types`` always get a column.
    """
    types = dict(types or {})
    names, more = json_columns(df, column, most)
    parsed = df.withColumn(rest, F.try_parse_json(column))

    def field(key: str) -> Column:
        quote = "'" if "'" not in key else '"'
        return F.try_variant_get(rest, f"$[{quote}{key}{quote}]", types.get(key, "string")).alias(key)

    named = sorted({*names, *types})
    plain = [k for k in named if not ("'" in k and '"' in k) and k]  # no path can name the others: they stay in the object
    more = more or len(plain) < len(named)
    kept = [c for c in df.columns if c != column]
    return parsed.select(*kept, *[field(k) for k in plain], *([rest] if more else []))


def override_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Inferred schema with overrides."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
