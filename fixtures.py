"""Change logs derived from the supplied tables (rules in FIXTURES.md).

Every log covers its whole table. The rules are modular arithmetic on a unique
key, so the end state has a closed form that the oracle SQL states directly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deltaloom.model import DELETE, INSERT, TRUNCATE, UPDATE, TableSpec, base_changes
from deltaloom.operators import evolve
from deltaloom.operators.barriers import bulk_rows
from deltaloom.operators.keyvalue import DEL, EXPIRE, HSET, RPUSH, SADD, SET, ZADD, kv_log

EPOCH = 1_700_000_000_000
STEP = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def commit_id(segment, key) -> Column:
    return F.lit(EPOCH) + F.lit(segment).cast("bigint") * STEP + key


def branch(part: Column) -> tuple[Column, Column]:
    return F.concat(F.lit("dev-"), part.cast("string")), F.concat(F.lit("branch-"), part.cast("string"))


# -- L1: orders ---------------------------------------------------------------------

def orders_spec(spark: SparkSession, sf_dir: str) -> TableSpec:
    return TableSpec.of("orders", table(spark, sf_dir, "orders"), "o_orderkey")


def orders_log(spark: SparkSession, sf_dir: str, redelivered: bool = True, segments: range = range(6)) -> DataFrame:
    """One scan of ``orders``; each row becomes the changes its key takes part in."""
    orders = table(spark, sf_dir, "orders")
    k, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    none = F.lit(None).cast("string")
    dtype = "struct<_segment:bigint,_op:string,_set_cols:array<string>,s:string,p:string,whole:boolean>"

    def change(segment, op, when, set_cols, s, p, whole):
        named = F.array(*[F.lit(c) for c in set_cols]) if set_cols else F.lit(None)
        return F.when(when, F.struct(F.lit(segment), F.lit(op), named, s, p, F.lit(whole)).cast(dtype))

    rules = [
        change(0, INSERT, F.lit(True), None, status, priority, True),
        change(1, UPDATE, k % 5 == 0, ["o_orderstatus"], F.lit("X"), none, False),
        change(2, DELETE, k % 7 == 0, None, none, none, False),
        change(3, INSERT, k % 21 == 0, None, F.lit("R"), priority, True),
        change(4, UPDATE, k % 14 == 0, ["o_orderstatus"], F.lit("Z"), none, False),
        change(5, UPDATE, k % 10 == 0, ["o_orderpriority"], none, none, False),
    ]
    log = orders.withColumn("_c", F.explode(F.array_compact(F.array(*[rules[i] for i in segments]))))
    if redelivered:
        log = log.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(k % 11 == 0, 2).otherwise(1))))
    c = F.col("_c")
    device, name = branch(F.col("o_custkey") % 4)
    values = {
        "o_custkey": F.when(c["whole"], F.col("o_custkey")),
        "o_orderstatus": c["s"],
        "o_totalprice": F.when(c["whole"], F.col("o_totalprice")),
        "o_orderdate": F.when(c["whole"], F.col("o_orderdate")),
        "o_orderpriority": c["p"],
    }
    return log.select(
        device.alias("_device_id"),
        name.alias("_device_name"),
        c["_segment"].alias("_segment"),
        k.alias("_seq"),
        F.lit(0).cast("bigint").alias("_txn_seq"),
        (F.lit(EPOCH) + c["_segment"] * STEP + k).alias("_commit_id"),
        c["_op"].alias("_op"),
        c["_set_cols"].alias("_set_cols"),
        k,
        *[v.alias(n) for n, v in values.items()],
    )


ORDERS_OPS = (INSERT, UPDATE, DELETE)


def orders_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit table of L1 that lacks the segment-1 commits of every 97th key."""
    log = orders_log(spark, sf_dir, redelivered=False)
    lost = (F.col("_segment") == 1) & (F.col("o_orderkey") % 97 == 0)
    return log.where(~lost).select("_device_id", "_commit_id", F.col("_seq").alias("operation_id"))


def orders_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    device, name = branch(F.col("o_custkey") % 4)
    return table(spark, sf_dir, "orders").select(device.alias("_device_id"), name.alias("_device_name")).distinct()


def orders_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applied positions: dev-0 through segment 1, dev-1 through segment 3, others none."""
    applied = orders_log(spark, sf_dir, redelivered=False).where(
        ((F.col("_device_id") == "dev-0") & (F.col("_segment") <= 1))
        | ((F.col("_device_id") == "dev-1") & (F.col("_segment") <= 3))
    )
    return applied.groupBy("_device_id", "_device_name").agg(
        F.max(F.struct("_segment", "_seq", "_txn_seq")).alias("_applied"),
        F.max("_commit_id").alias("_applied_commit"),
    )


def _device_change(devices: DataFrame, spec: TableSpec, op: str, segment: int, seq: int) -> DataFrame:
    return devices.select(
        "_device_id",
        "_device_name",
        F.lit(segment).cast("bigint").alias("_segment"),
        F.lit(seq).cast("bigint").alias("_seq"),
        F.lit(0).cast("bigint").alias("_txn_seq"),
        commit_id(segment, F.lit(seq)).alias("_commit_id"),
        F.lit(op).alias("_op"),
        F.lit(None).cast("array<string>").alias("_set_cols"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields],
    )


AFTER_ALL = 10**15


def orders_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dev-1 truncates its table at the end of segment 2."""
    devices = orders_devices(spark, sf_dir).where(F.col("_device_id") == "dev-1")
    return _device_change(devices, orders_spec(spark, sf_dir), TRUNCATE, 2, AFTER_ALL)


def orders_bulk(spark: SparkSession, sf_dir: str, delete: bool, update: bool) -> DataFrame:
    """dev-2, at the end of segment 4: bulk delete by price, then bulk update by status."""
    devices = orders_devices(spark, sf_dir).where(F.col("_device_id") == "dev-2")
    common = {"device_id": F.col("_device_id"), "device_name": F.col("_device_name"), "segment": F.lit(4)}
    parts = []
    if delete:
        parts.append(
            bulk_rows(
                devices,
                **common,
                seq=F.lit(AFTER_ALL),
                commit_id=commit_id(4, F.lit(AFTER_ALL)),
                op="DELETE_WHERE",
                terms=[("o_totalprice", ">", F.lit(200000))],
            )
        )
    if update:
        parts.append(
            bulk_rows(
                devices,
                **common,
                seq=F.lit(AFTER_ALL + 1),
                commit_id=commit_id(4, F.lit(AFTER_ALL + 1)),
                op="UPDATE_WHERE",
                predicate="o_orderstatus = 'R'",
                values={"o_orderstatus": F.lit("B")},
            )
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# -- L2: customer -------------------------------------------------------------------

def customer_spec(spark: SparkSession, sf_dir: str) -> TableSpec:
    return TableSpec.of("customer", table(spark, sf_dir, "customer"), "c_custkey")


def customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 2 == 0)
    return base_changes(rows, customer_spec(spark, sf_dir), "dev-0", "branch-0", EPOCH)


def customer_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers but the new ones, the odd multiples of 3: with the changes every key is seen."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").where((k % 2 == 0) | (k % 3 != 0))
    return base_changes(rows, customer_spec(spark, sf_dir), "dev-0", "branch-0", EPOCH)


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT changes that name only the key and ``c_acctbal = 0``."""
    spec = customer_spec(spark, sf_dir)
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").where(k % 3 == 0)
    return rows.select(
        F.lit("dev-0").alias("_device_id"),
        F.lit("branch-0").alias("_device_name"),
        F.lit(0).cast("bigint").alias("_segment"),
        k.alias("_seq"),
        F.lit(0).cast("bigint").alias("_txn_seq"),
        commit_id(0, k).alias("_commit_id"),
        F.lit(INSERT).alias("_op"),
        F.array(F.lit("c_custkey"), F.lit("c_acctbal")).alias("_set_cols"),
        *[
            (k if f.name == "c_custkey" else F.lit(0.0) if f.name == "c_acctbal" else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in spec.schema.fields
        ],
    )


def customer_conflicting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base, conflicting inserts, then an UPDATE for %5 keys and a DELETE for %10 keys."""
    spec = customer_spec(spark, sf_dir)
    k = F.col("c_custkey")

    def more(segment, op, when, set_cols):
        return table(spark, sf_dir, "customer").where(when).select(
            F.lit("dev-0").alias("_device_id"),
            F.lit("branch-0").alias("_device_name"),
            F.lit(segment).cast("bigint").alias("_segment"),
            k.alias("_seq"),
            F.lit(0).cast("bigint").alias("_txn_seq"),
            commit_id(segment, k).alias("_commit_id"),
            F.lit(op).alias("_op"),
            set_cols.cast("array<string>").alias("_set_cols"),
            *spec.columns,
        )

    updates = more(1, UPDATE, k % 5 == 0, F.array(F.lit("c_name")))
    deletes = more(2, DELETE, k % 10 == 0, F.lit(None))
    again = more(3, DELETE, k % 20 == 0, F.lit(None))
    return (
        customer_base(spark, sf_dir)
        .unionByName(customer_changes(spark, sf_dir))
        .unionByName(updates)
        .unionByName(deletes)
        .unionByName(again)
    )


# -- L3: part, schema evolution --------------------------------------------------------

def part_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices are read off the table; even and odd ones take different DDL steps."""
    device, name = branch(F.col("p_partkey") % 2)
    devices = (
        table(spark, sf_dir, "part")
        .select((F.col("p_partkey") % 2).alias("d"), device.alias("_device_id"), name.alias("_device_name"))
        .distinct()
    )
    def step(seq, op, when, column=None, to=None):
        entry = F.struct(F.lit(seq), F.lit(op), F.lit(column), F.lit(to))
        return F.when(when, entry.cast("struct<s:int,op:string,c:string,to:string>"))

    d = F.col("d")
    taken = F.array(
        step(0, evolve.CREATE_TABLE, F.lit(True)),
        step(1, evolve.ADD_COLUMN, d == 0, "tag"),
        step(1, evolve.RENAME_COLUMN, d == 1, "p_size", "p_sz"),
        step(2, evolve.DROP_COLUMN, d == 1, "p_name"),
    )
    steps = devices.select("*", F.explode(F.array_compact(taken)).alias("x"))
    x = F.col("x")
    segment = F.when(x["s"] == 0, 0).otherwise(2)
    return evolve.ddl_rows(
        steps,
        device_id=F.col("_device_id"),
        device_name=F.col("_device_name"),
        segment=segment,
        seq=x["s"],
        commit_id=F.lit(EPOCH) + segment * STEP + x["s"],
        table=F.lit("part"),
        op=x["op"],
        column=x["c"],
        dtype=F.when(x["op"] == evolve.ADD_COLUMN, "TEXT"),
        to=x["to"],
        columns={"p_partkey": "INTEGER", "p_name": "TEXT", "p_size": "INTEGER"},
        keys=("p_partkey",),
    )


def part_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows under the column names their device used at the time."""
    k = F.col("p_partkey")
    rest = k % 4
    device, name = branch(k % 2)
    early = rest.isin(0, 1)
    size = F.col("p_size").cast("bigint")
    segment = F.when(early, 1).otherwise(3).cast("bigint")
    return table(spark, sf_dir, "part").select(
        device.alias("_device_id"),
        name.alias("_device_name"),
        segment.alias("_segment"),
        k.alias("_seq"),
        F.lit(0).cast("bigint").alias("_txn_seq"),
        (F.lit(EPOCH) + segment * STEP + k).alias("_commit_id"),
        F.lit(INSERT).alias("_op"),
        F.when(early, F.array(F.lit("p_partkey"), F.lit("p_name"), F.lit("p_size")))
        .when(rest == 2, F.array(F.lit("p_partkey"), F.lit("p_name"), F.lit("p_size"), F.lit("tag")))
        .otherwise(F.array(F.lit("p_partkey"), F.lit("p_sz")))
        .alias("_set_cols"),
        F.lit("part").alias("_table"),
        k,
        F.when(rest != 3, F.col("p_name")).alias("p_name"),
        F.when(rest != 3, size).alias("p_size"),
        F.when(rest == 2, F.lit("t")).alias("tag"),
        F.when(rest == 3, size).alias("p_sz"),
    )


def customer_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer is a device that issues one DDL statement, by key."""
    k = F.col("c_custkey")
    op = (
        F.when(k % 10 == 0, evolve.DROP_TABLE)
        .when(k % 10 == 1, evolve.DROP_COLUMN)
        .when(k % 10 == 2, evolve.ADD_COLUMN)
        .otherwise(evolve.RENAME_COLUMN)
    )
    return evolve.ddl_rows(
        table(spark, sf_dir, "customer"),
        device_id=F.concat(F.lit("dev-"), k),
        device_name=F.col("c_name"),
        segment=F.lit(0),
        seq=k,
        commit_id=F.lit(EPOCH) + k,
        table=F.lower("c_mktsegment"),
        op=op,
        column=F.lit("note"),
        dtype=F.lit("TEXT"),
        to=F.lit("remark"),
    )


# -- L4: command log of orders ---------------------------------------------------------

ORDERS_DDL = (
    "CREATE TABLE orders (o_orderkey INTEGER PRIMARY KEY, o_custkey INTEGER, o_orderstatus TEXT, "
    "o_totalprice REAL, o_orderdate TEXT, o_orderpriority TEXT)"
)


def orders_commands(spark: SparkSession, sf_dir: str, batched: bool = True) -> DataFrame:
    """L1 as statements with bound arguments, one CREATE TABLE per device first.

    In segment 0 every other row of a device has an empty statement: it repeats
    the one before it.
    """
    log = orders_log(spark, sf_dir, redelivered=False)
    insert = (
        "INSERT INTO orders (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority) "
        "VALUES (?, ?, ?, ?, ?, ?)"
    )

    def raw(c: str) -> Column:
        return F.col(c).cast("string").cast("binary")

    op, segment = F.col("_op"), F.col("_segment")
    statement = (
        F.when(op == INSERT, insert)
        .when(op == DELETE, "DELETE FROM orders WHERE o_orderkey = ?")
        .when(segment == 5, "UPDATE orders SET o_orderpriority = NULL WHERE o_orderkey = ?")
        .otherwise("UPDATE orders SET o_orderstatus = ? WHERE o_orderkey = ?")
    )
    args = (
        F.when(
            op == INSERT,
            F.array(*[raw(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")]),
        )
        .when((op == DELETE) | (segment == 5), F.array(raw("o_orderkey")))
        .otherwise(F.array(raw("o_orderstatus"), raw("o_orderkey")))
    )
    text = F.when((segment == 0) & (F.col("o_orderkey") % 2 == 1), "").otherwise(statement) if batched else statement
    rows = log.select(
        "_device_id",
        "_device_name",
        "_segment",
        (F.col("_seq") + 2).alias("_seq"),
        "_txn_seq",
        "_commit_id",
        text.alias("sql"),
        args.alias("args"),
    )
    # Every device opens with CREATE TABLE and one full INSERT, whose row it
    # deletes again in segment 1: no batched row stands without a statement.
    own = F.concat(F.lit("-"), F.substring("_device_id", 5, 10))

    def row(segment, seq, text, *values):
        entry = F.struct(F.lit(segment), F.lit(seq), text, F.array(*values).cast("array<string>"))
        return entry.cast("struct<g:bigint,q:bigint,sql:string,a:array<string>>")

    undo = F.concat(F.lit("DELETE FROM orders WHERE o_orderkey = "), own, F.lit("1"))
    opening = (
        orders_devices(spark, sf_dir)
        .withColumn(
            "_x",
            F.explode(
                F.array(
                    row(0, 0, F.lit(ORDERS_DDL)),
                    row(0, 1, F.lit(insert), F.concat(own, F.lit("1"))),
                    row(1, 0, undo),
                )
            ),
        )
        .select(
            "_device_id",
            "_device_name",
            F.col("_x.g").alias("_segment"),
            F.col("_x.q").alias("_seq"),
            F.lit(0).cast("bigint").alias("_txn_seq"),
            commit_id(F.col("_x.g"), F.lit(0)).alias("_commit_id"),
            F.col("_x.sql").alias("sql"),
            F.transform("_x.a", lambda v: v.cast("binary")).alias("args"),
        )
    )
    return rows.unionByName(opening)


# -- L5: messages ------------------------------------------------------------------------

def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    payload = F.concat_ws(";", e, F.col("user_id"), F.col("value"))
    return table(spark, sf_dir, "events").select(
        e,
        F.concat(F.lit("site/"), F.col("user_id") % 3, F.lit("/"), F.col("event_type")).alias("topic"),
        F.when(e % 50 == 0, "garbage").otherwise(payload).alias("payload"),
        F.col("ts"),
    )


def fleet_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic per user and type; sign-ups are published on the user's own level."""
    e = table(spark, sf_dir, "events")
    own = F.concat(F.lit("fleet/"), F.col("user_id"))
    return e.select("event_id", "user_id", F.when(F.col("event_type") == "signup", own).otherwise(F.concat_ws("/", own, "event_type")).alias("topic"))


def fleet_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rules for alerts, two or three per customer, one for the rest."""
    k = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer")
    own = customers.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.struct((k * 2 + 10).alias("rule"), F.concat(F.lit("fleet/"), k, F.lit("/purchase")).alias("pattern"), F.concat(F.lit("sales_"), k % 7).alias("target")),
                    F.when(k % 2 == 0, F.struct((k * 2 + 11).alias("rule"), F.concat(F.lit("fleet/"), k, F.lit("/#")).alias("pattern"), F.lit("even").alias("target"))),
                )
            )
        ).alias("r")
    ).select("r.*")
    fixed = [(0, "+/+/error", "alerts"), (1, "fleet/+/click", "alerts"), (10**12, "fleet/#", "rest")]
    return own.unionByName(spark.createDataFrame(fixed, "rule bigint, pattern string, target string"))


# -- L6: key-value log --------------------------------------------------------------------

def kv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls per event; positions are event_id * 2 (+1 for the second call of a click)."""
    events = table(spark, sf_dir, "events")
    kind, user, e = F.col("event_type"), F.col("user_id"), F.col("event_id")
    value = F.col("value").cast("string")

    def key(prefix):
        return F.concat(F.lit(prefix), user)

    first = kv_log(
        events,
        ord=e * 2,
        ts=F.col("ts"),
        call=F.when(kind == "view", SET).when(kind == "click", HSET).when(kind == "purchase", RPUSH).when(kind == "error", EXPIRE).otherwise(DEL),
        key=F.when(kind.isin("view", "error"), key("user:")).when(kind == "purchase", key("q:")).otherwise(key("h:")),
        value=F.when(kind == "view", value),
        fields=F.when(kind == "click", F.create_map((e % 5).cast("string"), value)),
        members=F.when(kind == "purchase", F.array(e.cast("string"))),
        ttl=F.when(kind == "error", 3600),
    )
    second = kv_log(
        events.where(kind.isin("click", "purchase")),
        ord=e * 2 + 1,
        ts=F.col("ts"),
        call=F.when(kind == "click", SADD).otherwise(ZADD),
        key=F.when(kind == "click", key("s:")).otherwise(F.lit("board")),
        members=F.when(kind == "click", F.array((e % 7).cast("string"))),
        scores=F.when(kind == "purchase", F.create_map(user.cast("string"), F.col("value"))),
    )
    return first.unionByName(second)


def kv_as_of() -> Column:
    """An instant after the last event."""
    return F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'")


def kv_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as calls on one key per user, which is written, given two days, deleted and written again."""
    events = table(spark, sf_dir, "events")
    kind, e = F.col("event_type"), F.col("event_id")
    call = F.when(kind == "click", HSET).when(kind == "purchase", RPUSH).when(kind == "view", SADD).when(kind == "error", EXPIRE).otherwise(DEL)
    return kv_log(
        events,
        ord=e,
        ts=F.col("ts"),
        call=call,
        key=F.concat(F.lit("session:"), F.col("user_id")),
        fields=F.when(kind == "click", F.create_map((e % 5).cast("string"), F.col("value").cast("string"))),
        members=F.when(kind == "purchase", F.array(e.cast("string"))).when(kind == "view", F.array((e % 7).cast("string"))),
        ttl=F.when(kind == "error", 2 * 86400),
    )


# -- L7: diff pair ---------------------------------------------------------------------------

def diff_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    source = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kept = source.where(k % 13 != 0).withColumn(
        "o_orderstatus", F.when(k % 17 == 0, "Q").otherwise(F.col("o_orderstatus"))
    )
    extra = source.where(k % 19 == 0).withColumn("o_orderkey", k + 10_000_000_000)
    return source, kept.unionByName(extra)



# -- forms of INSERT: orders ------------------------------------------------------------------------

def shaped_commands(spark: SparkSession, sf_dir: str, refused: bool = False) -> DataFrame:
    """Two rows of values in one statement for every pair of orders, one with bound values and one with literals; then deletes, and inserts that ignore conflicts.

    With ``refused`` dev-2 issues a statement with an expression before its deletes.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey")
    pair = F.floor(k / 2).cast("bigint")
    device, name = branch(pair % 4)
    owner = [device.alias("_device_id"), name.alias("_device_name")]
    columns = "(o_orderkey, o_orderstatus, o_totalprice)"
    literal = F.concat(F.lit("("), "second", F.lit(", '"), "status", F.lit(" (it''s), a', "), "price", F.lit(")"))
    second = orders.select(k.alias("second"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    pairs = orders.where(k % 2 == 0).join(second, F.col("second") == k + 1, "left").withColumn("more", F.coalesce(F.concat(F.lit(", "), literal), F.lit("")))

    def rows(df, segment, sql, *args):
        bound = F.array(*[a.cast("string").cast("binary") for a in args]) if args else F.array().cast("array<binary>")
        place = [F.lit(segment).cast("bigint").alias("_segment"), (k + 1).alias("_seq"), F.lit(0).cast("bigint").alias("_txn_seq")]
        return df.select(*owner, *place, (F.lit(EPOCH) + segment * STEP + k).alias("_commit_id"), sql.alias("sql"), bound.alias("args"))

    created = F.lit("CREATE TABLE orders (o_orderkey INTEGER PRIMARY KEY, o_orderstatus TEXT, o_totalprice REAL)")
    nothing = F.lit(f"INSERT INTO orders {columns} VALUES (?, ?, ?), (?, ?, 0) ON CONFLICT (o_orderkey) DO NOTHING")
    far = k + 10**9
    parts = [
        rows(orders.where(k % 2 == 0).where(pair < 4), 0, created),
        rows(pairs, 1, F.concat(F.lit(f"INSERT INTO orders {columns} VALUES (?, ?, ?)"), "more"), k, F.col("o_orderstatus"), F.col("o_totalprice")),
        rows(orders.where(k % 9 == 0), 3, F.lit("DELETE FROM orders WHERE o_orderkey = ?"), k),
        rows(orders.where(k % 3 == 0), 4, F.lit(f"INSERT OR IGNORE INTO orders {columns} VALUES (?, 'again?', 1)"), k),
        rows(orders.where(k % 10 == 0), 5, nothing, far, F.lit("one"), F.lit(2), far, F.lit("two")),
    ]
    if refused:
        parts.append(rows(orders.where(k % 2 == 0).where(pair == 2), 2, F.lit("UPDATE orders SET o_totalprice = o_totalprice + 1 WHERE o_orderkey = 4")))
    return reduce(DataFrame.unionByName, parts)


# -- defaults and widening: supplier -----------------------------------------------------------

def supplier_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even suppliers come before the column ``rating`` is added with a default, odd ones after, some of them naming it; then it is widened."""
    k = F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier")
    device, name = branch(k % 3)
    owner = [device.alias("_device_id"), name.alias("_device_name")]
    devices = suppliers.select(*owner).distinct()

    def rows(df, segment, seq, sql, *args):
        bound = F.array(*[a.cast("string").cast("binary") for a in args]) if args else F.array().cast("array<binary>")
        place = [F.lit(segment).cast("bigint").alias("_segment"), seq.cast("bigint").alias("_seq"), F.lit(0).cast("bigint").alias("_txn_seq")]
        who = ["_device_id", "_device_name"] if not args else owner
        return df.select(*who, *place, (F.lit(EPOCH) + segment * STEP + seq).cast("bigint").alias("_commit_id"), F.lit(sql).alias("sql"), bound.alias("args"))

    start = F.lit(0)
    plain, named = "INSERT INTO supplier (s_suppkey, s_name) VALUES (?, ?)", "INSERT INTO supplier (s_suppkey, s_name, rating) VALUES (?, ?, ?)"
    parts = [
        rows(devices, 0, start, "CREATE TABLE supplier (s_suppkey INTEGER PRIMARY KEY, s_name TEXT, s_note TEXT DEFAULT 'it''s new, so far')"),
        rows(suppliers.where(k % 2 == 0), 1, k, plain, k, F.col("s_name")),
        rows(devices, 2, start, "ALTER TABLE supplier ADD COLUMN rating INTEGER NOT NULL DEFAULT 7"),
        rows(suppliers.where(k % 4 == 1), 3, k, named, k, F.col("s_name"), k),
        rows(suppliers.where(k % 4 == 3), 3, k, plain, k, F.col("s_name")),
        rows(suppliers.where(k % 6 == 0), 4, k, "UPDATE supplier SET rating = 0 WHERE s_suppkey = ?", k),
        rows(devices, 5, start, "ALTER TABLE supplier ALTER COLUMN rating TYPE REAL"),
        rows(suppliers.where(k % 10 == 0), 6, k, "UPDATE supplier SET rating = ?, s_note = NULL WHERE s_suppkey = ?", F.lit(2.5), k),
    ]
    return reduce(DataFrame.unionByName, parts)


# -- table renames: supplier --------------------------------------------------------------------

def supplier_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All devices create ``supplier``; 0 and 1 rename it to ``vendor``, 2 drops it."""
    device, name = branch(F.col("s_suppkey") % 3)
    devices = table(spark, sf_dir, "supplier").select(device.alias("_device_id"), name.alias("_device_name")).distinct()
    steps = devices.withColumn("s", F.explode(F.array(F.lit(0), F.lit(2))))
    is_last = F.col("_device_id") == "dev-2"
    return evolve.ddl_rows(
        steps,
        device_id=F.col("_device_id"),
        device_name=F.col("_device_name"),
        segment=F.col("s"),
        seq=F.lit(0),
        commit_id=F.lit(EPOCH) + F.col("s"),
        table=F.lit("supplier"),
        op=F.when(F.col("s") == 0, evolve.CREATE_TABLE)
        .when(is_last, evolve.DROP_TABLE)
        .otherwise(evolve.RENAME_TABLE),
        to=F.lit("vendor"),
        columns={"s_suppkey": "INTEGER", "s_name": "TEXT"},
        keys=("s_suppkey",),
    )


def supplier_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even keys are written before the rename, odd ones after it (not by dev-2)."""
    k = F.col("s_suppkey")
    device, name = branch(k % 3)
    early = k % 2 == 0
    segment = F.when(early, 1).otherwise(3).cast("bigint")
    rows = table(spark, sf_dir, "supplier").where(early | (k % 3 != 2))
    return rows.select(
        device.alias("_device_id"),
        name.alias("_device_name"),
        segment.alias("_segment"),
        k.alias("_seq"),
        F.lit(0).cast("bigint").alias("_txn_seq"),
        (F.lit(EPOCH) + segment * STEP + k).alias("_commit_id"),
        F.lit(INSERT).alias("_op"),
        F.lit(None).cast("array<string>").alias("_set_cols"),
        F.when(early, "supplier").otherwise("vendor").alias("_table"),
        k,
        "s_name",
    )


# -- L4 as files --------------------------------------------------------------------------------

ROLLS = 1_000_000
FILE_KEYS = 50_000
TXN_KEYS = 10_000
STAGE_PATTERN = r"/(?P<name>branch-\d+)_(?P<id>dev-\d+)/"


def orders_text_spec(spark: SparkSession) -> TableSpec:
    columns = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
    return TableSpec("orders", spark.createDataFrame([], columns).schema, ("o_orderkey",))


def stage_segments(spark: SparkSession, sf_dir: str, path: str, dense: bool = False) -> str:
    """Write the command log of ``orders`` as SQLite files, one folder per device.

    A segment rolls after FILE_KEYS keys, so no file (and no task) grows with
    the table. dev-3 publishes transactions of TXN_KEYS keys each. With ``dense``
    the files of a device are numbered 0, 1, 2, ... without gaps. Returns the path.
    """
    k = F.col("_seq") - 2
    log = orders_commands(spark, sf_dir, batched=False).where((F.col("_seq") > 1) | F.col("sql").startswith("CREATE"))
    keyed = log.withColumn("_key", F.when(F.col("_seq") > 1, k).otherwise(F.lit(-1).cast("bigint")))
    placed = keyed.withColumn("_number", F.col("_segment") * ROLLS + F.floor(F.greatest("_key", F.lit(0)) / FILE_KEYS))
    if dense:
        numbers = placed.select("_device_id", "_number").distinct()
        nth = F.row_number().over(Window.partitionBy("_device_id").orderBy("_number")) - 1
        numbers = numbers.withColumn("_dense", nth.cast("bigint"))
        placed = placed.join(numbers, ["_device_id", "_number"]).withColumn("_number", F.col("_dense")).drop("_dense")
    publishes = (F.col("_device_id") == "dev-3") & (F.col("_key") >= 0)
    block = F.floor(F.col("_key") / TXN_KEYS) * TXN_KEYS
    rows = placed.withColumn(
        "_commit_id", F.when(publishes, F.lit(EPOCH) + F.col("_segment") * STEP + block).otherwise(F.col("_commit_id"))
    ).withColumn("_txn", F.when(publishes, F.col("_commit_id")))
    files = rows.select(
        "_device_id",
        "_device_name",
        F.col("_number").cast("bigint").alias("_number"),
        "_txn",
        F.col("_key").alias("_seq"),
        "_commit_id",
        "sql",
        "args",
    )
    controls = (
        files.where(F.col("_txn").isNotNull())
        .groupBy("_device_id", "_device_name", "_number", "_commit_id")
        .agg(F.min("_seq").alias("_seq"))
        .select(
            "_device_id",
            "_device_name",
            "_number",
            F.lit(None).cast("bigint").alias("_txn"),
            "_seq",
            "_commit_id",
            F.concat(F.lit("REPLAY_TXN("), "_commit_id", F.lit(")")).alias("sql"),
            F.array().cast("array<binary>").alias("args"),
        )
    )
    written = (
        files.unionByName(controls)
        .groupBy("_device_id", "_device_name", "_number", "_txn")
        .applyInPandas(_segment_writer(path), "file string, n_rows bigint")
    )
    written.agg(F.sum("n_rows")).collect()
    return path


def _segment_writer(root: str):
    """Writes one SQLite file per group; batched rows lose their repeated statement."""

    def write(rows):
        import os
        import shutil
        import sqlite3
        import tempfile

        import pandas as pd

        rows = rows.sort_values("_seq").reset_index(drop=True)
        first = rows.iloc[0]
        number, txn = int(first["_number"]), first["_txn"]
        is_txn = not pd.isna(txn)
        name = f"{number}.sqllog" + (f".{int(txn)}.txn" if is_txn else "")
        folder = f"{root}/{first['_device_name']}_{first['_device_id']}"
        repeated = (rows["sql"] == rows["sql"].shift()) & (rows.index % 2 == 1) & ~rows["sql"].str.startswith("REPLAY")
        slots = [f"arg{i}" for i in range(1, 17)]

        def save(file_name, statements):
            handle, scratch = tempfile.mkstemp(suffix=".db")
            os.close(handle)
            try:
                conn = sqlite3.connect(scratch)
                for text, values in statements:
                    conn.executemany(text, values)
                conn.commit()
                conn.close()
                plain = folder[len("file:"):] if folder.startswith("file:") else folder
                if "://" in plain:
                    from pyarrow import fs

                    files, inner = fs.FileSystem.from_uri(folder)
                    files.create_dir(inner, recursive=True)
                    with open(scratch, "rb") as source, files.open_output_stream(f"{inner}/{file_name}") as out:
                        shutil.copyfileobj(source, out, 1 << 20)
                else:
                    os.makedirs(plain, exist_ok=True)
                    shutil.copyfile(scratch, f"{plain}/{file_name}")
            finally:
                os.unlink(scratch)

        # Table layouts, metadata keys and states of a segment file
        table = [
            "CREATE TABLE commandlog (change_sequence_number INTEGER PRIMARY KEY, commit_id INTEGER, sql TEXT, argcnt INTEGER, "
            + ", ".join(f"{s} BLOB" for s in slots) + ")"
        ]
        values = []
        for row, blank in zip(rows.to_dict("records"), repeated):
            args = [None if a is None else bytes(a) for a in row["args"]]
            values.append(
                [int(row["_seq"]), int(row["_commit_id"]), "" if blank else row["sql"], len(args)]
                + args + [None] * (len(slots) - len(args))
            )
        marks = ", ".join("?" * (4 + len(slots)))
        save(name, [(table[0], [()]), (f"INSERT OR REPLACE INTO commandlog VALUES ({marks})", values)])
        if not is_txn:
            applied = first["_device_id"] == "dev-2" and number // ROLLS == 1
            meta = [
                ("uuid", first["_device_id"]),
                ("device-name", first["_device_name"]),
                ("database-name", "orders"),
                ("log-segment-sequence-number", str(number)),
                ("status", "APPLIED" if applied else "READY_TO_APPLY"),
            ]
            save(
                f"{number}.metadata",
                [("CREATE TABLE metadata (key TEXT, value TEXT)", [()]), ("INSERT INTO metadata VALUES (?, ?)", meta)],
            )
        return pd.DataFrame({"file": [name], "n_rows": [len(rows)]})

    return write


def read_stage(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Staged files -> (log with transactions expanded and applied segments left out, held back)."""
    from deltaloom.operators.normalize import expand_transactions
    from deltaloom.sources import segments as sg

    metadata = sg.segment_metadata(sg.scan_metadata(spark, path, STAGE_PATTERN))
    master = sg.ready_segments(sg.scan_log(spark, path, STAGE_PATTERN), metadata)
    return expand_transactions(master, sg.scan_transactions(spark, path, STAGE_PATTERN))
