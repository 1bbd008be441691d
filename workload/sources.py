"""Sources, sinks, messages, table operations, key-value state."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from deltaloom.model import INSERT, UPSERT, TableSpec, as_changes
from deltaloom.operators import keyvalue as kv
from deltaloom.operators import tables as tb
from deltaloom.operators.fold import fold
from deltaloom.sinks import writers
from deltaloom.sources import files, messages
from deltaloom.storage import fresh_dir
from workload import Registry
from workload import closed_forms as cf

registry = Registry()
add = registry.add

# -- table sources -----------------------------------------------------------------------

MARK = "TIMESTAMP_NTZ'1998-01-01 00:00:00'"


@add("incremental_read", "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'")
def incremental_read(spark, sf):
    return files.read_after(fx.table(spark, sf, "orders"), "o_orderdate", F.expr(MARK))


@add(
    "incremental_mark",
    "SELECT max(o_orderdate) AS new_mark, count(*) AS n FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'",
)
def incremental_mark(spark, sf):
    return incremental_read(spark, sf).agg(F.max("o_orderdate").alias("new_mark"), F.count("*").alias("n"))


@add(
    "incremental_changes",
    "SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate > TIMESTAMP '1998-01-01 00:00:00' THEN 'N' ELSE o_orderstatus END "
    "AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def incremental_changes(spark, sf):
    """A first full load, then rows beyond the mark arrive again, changed, as upserts."""
    spec = fx.orders_spec(spark, sf)
    orders = fx.table(spark, sf, "orders")
    same = {"device_id": "src", "device_name": "src"}
    first = files.incremental_changes(orders, spec, "o_orderdate", None, **same, segment=0, commit_id=fx.EPOCH)
    changed = orders.withColumn("o_orderstatus", F.lit("N"))
    then = files.incremental_changes(
        changed, spec, "o_orderdate", F.expr(MARK), **same, segment=1, commit_id=fx.EPOCH + 1
    )
    return fold(first.unionByName(then), spec, (UPSERT,)).select(*spec.columns)


@add(
    "multi_source",
    "SELECT 'crm' AS source, 'customer' AS table_name, count(*) AS n FROM customer UNION ALL "
    "SELECT 'erp', 'orders', count(*) FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00' UNION ALL "
    "SELECT 'erp', 'supplier', count(*) FROM supplier",
)
def multi_source(spark, sf):
    jobs = [
        files.ReadJob("crm", "customer", include=("c_custkey", "c_name")),
        files.ReadJob("erp", "orders", files.INCREMENTAL, "o_orderdate", F.expr(MARK)),
        files.ReadJob("erp", "supplier", exclude=("s_acctbal",)),
    ]
    frames = files.read_jobs(jobs, lambda job: fx.table(spark, sf, job.table))
    tagged = None
    for df in frames.values():
        part = df.select(F.col("_source").alias("source"), F.col("_table").alias("table_name"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("source", "table_name").agg(F.count("*").alias("n"))


@add(
    "change_feed",
    "SELECT user_id, arg_max(event_type, event_id) AS last_event, arg_max(value, event_id) AS last_value "
    "FROM events GROUP BY user_id",
)
def change_feed(spark, sf):
    """Captured row events applied directly: the last event per user."""
    feed = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    spec = TableSpec("last_event", feed.select("user_id", "event_type", "value").schema, ("user_id",))
    log = files.read_feed(
        feed,
        {"_seq": "event_id", "_commit_id": fx.commit_id(0, F.col("event_id")), "_op": F.lit(INSERT)},
        spec,
    )
    return fold(log, spec, (INSERT,)).select(
        "user_id", F.col("event_type").alias("last_event"), F.col("value").alias("last_value")
    )


@add("csv_round_trip", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_round_trip(spark, sf):
    part = fx.table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    path = fresh_dir(spark, "part-csv")
    writers.write(part, writers.Destination("csv", path))
    return files.read_csv(spark, path, part.schema)


@add("parquet_per_device", cf.orders_rows(where=f"{cf.ALIVE} AND o_custkey % 4 = 2", system=False))
def parquet_per_device(spark, sf):
    """Replicated tables written one directory per device; one of them read back alone."""
    from deltaloom.plans.replay import replicate

    copies = replicate(fx.orders_log(spark, sf), fx.orders_spec(spark, sf), fx.ORDERS_OPS).drop("_device_name")
    path = fresh_dir(spark, "per-device")
    writers.write(copies, writers.per_device(path))
    return files.read_parquet(spark, f"{path}/_device_id=dev-2")


@add(
    "merge_schema_read",
    "SELECT event_id, event_type, CASE WHEN event_id % 2 = 1 THEN value END AS value FROM events",
)
def merge_schema_read(spark, sf):
    """Append files whose columns grew: old files lack the new column."""
    events = fx.table(spark, sf, "events")
    path = fresh_dir(spark, "grown")
    events.where(F.col("event_id") % 2 == 0).select("event_id", "event_type").write.parquet(f"{path}/a")
    events.where(F.col("event_id") % 2 == 1).select("event_id", "event_type", "value").write.parquet(f"{path}/b")
    return files.read_parquet(spark, f"{path}/a", f"{path}/b", merge_schema=True)


# -- messages --------------------------------------------------------------------------------

PAYLOAD_SCHEMA = "id bigint, user bigint, reading double"


@add(
    "iot_parse",
    "SELECT 'site/' || (user_id % 3) || '/' || event_type AS topic, event_id AS id, user_id AS \"user\", value AS reading "
    "FROM events WHERE event_id % 50 <> 0",
)
def iot_parse(spark, sf):
    parsed = messages.parse_payload(fx.messages(spark, sf), PAYLOAD_SCHEMA, ";")
    return messages.accepted(parsed, "topic")


@add(
    "iot_rejects",
    "SELECT event_id, 'site/' || (user_id % 3) || '/' || event_type AS topic, 'garbage' AS payload FROM events "
    "WHERE event_id % 50 = 0",
)
def iot_rejects(spark, sf):
    parsed = messages.parse_payload(fx.messages(spark, sf), PAYLOAD_SCHEMA, ";")
    return messages.rejected(parsed).select("event_id", "topic", "payload")


TOPIC_RULES = [
    messages.TopicRule("site/0/error", "alarms"),
    messages.TopicRule("site/+/purchase", "sales"),
    messages.TopicRule("site/1/#", "site_one", {"id": "event_id", "reading": "measured"}),
]


@add(
    "topic_mapping",
    "SELECT CASE WHEN user_id % 3 = 0 AND event_type = 'error' THEN 'alarms' WHEN event_type = 'purchase' THEN 'sales' "
    "WHEN user_id % 3 = 1 THEN 'site_one' END AS table_name, count(*) AS n FROM events GROUP BY 1",
)
def topic_mapping(spark, sf):
    mapped = messages.map_topics(fx.messages(spark, sf), TOPIC_RULES)
    return mapped.groupBy(F.col("_table").alias("table_name")).agg(F.count("*").alias("n"))


@add(
    "topic_mapping_table",
    "SELECT CASE WHEN event_type IN ('error', 'click') THEN 'alerts' WHEN c_custkey IS NOT NULL AND event_type = 'purchase' THEN 'sales_' || (c_custkey % 7) "
    "WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'rest' END AS table_name, "
    "CASE WHEN event_type = 'error' THEN 0 WHEN event_type = 'click' THEN 1 WHEN c_custkey IS NOT NULL AND event_type = 'purchase' THEN c_custkey * 2 + 10 "
    "WHEN c_custkey % 2 = 0 THEN c_custkey * 2 + 11 ELSE 1000000000000 END AS rule, count(*) AS n "
    "FROM events LEFT JOIN customer ON c_custkey = user_id GROUP BY 1, 2",
)
def topic_mapping_table(spark, sf):
    """Rules as a table, some per customer: two rules for one target, ``#`` on the level above, the first match wins."""
    mapped = messages.route_topics(fx.fleet_messages(spark, sf), fx.fleet_rules(spark, sf))
    return mapped.groupBy(F.col("_table").alias("table_name"), F.col("_rule").alias("rule")).agg(F.count("*").alias("n"))


@add(
    "topic_columns",
    "SELECT event_id, value AS measured FROM events WHERE event_id % 50 <> 0 AND user_id % 3 = 1 "
    "AND event_type <> 'purchase'",
)
def topic_columns(spark, sf):
    mapped = messages.map_topics(fx.messages(spark, sf).drop("event_id", "ts"), TOPIC_RULES)
    parsed = messages.parse_payload(mapped, PAYLOAD_SCHEMA, ";")
    return messages.rows_for(messages.accepted(parsed, "_table"), TOPIC_RULES[2])


@add(
    "topic_records",
    "SELECT event_type AS topic, 'u-' || user_id AS \"key\", TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k "
    "FROM events",
)
def topic_records(spark, sf):
    """Topic / key / value records appended per topic and read back with their JSON values."""
    records = fx.table(spark, sf, "events").select(
        F.col("event_type").alias("topic"),
        F.concat(F.lit("u-"), F.col("user_id")).cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    )
    path = fresh_dir(spark, "topics")
    messages.append_records(messages.decode_records(records), path)
    return messages.json_values(files.read_parquet(spark, path), "k bigint")


# -- table operations --------------------------------------------------------------------------

@add(
    "store_update",
    "SELECT c_custkey, c_acctbal, CASE WHEN c_nationkey % 2 = 0 THEN 'moved' ELSE c_mktsegment END AS c_mktsegment, "
    "CASE WHEN c_nationkey % 2 = 0 THEN n_name END AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def store_update(spark, sf):
    """Many parameter rows at once; an unseen column is added."""
    params = (
        fx.table(spark, sf, "nation")
        .where(F.col("n_nationkey") % 2 == 0)
        .select(F.col("n_nationkey").alias("c_nationkey"), F.lit("moved").alias("set_c_mktsegment"), F.col("n_name").alias("set_nation"))
    )
    updated = tb.update_each(fx.table(spark, sf, "customer"), params, ["c_nationkey"], F.lit(1))
    return updated.select("c_custkey", "c_acctbal", "c_mktsegment", "nation")


@add("store_delete", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey % 3 <> 0")
def store_delete(spark, sf):
    params = fx.table(spark, sf, "nation").where(F.col("n_nationkey") % 3 == 0).select(
        F.col("n_nationkey").alias("c_nationkey")
    )
    return tb.delete_each(fx.table(spark, sf, "customer"), params, ["c_nationkey"]).select("c_custkey", "c_name")


@add(
    "store_update_one",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey = 3 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal "
    "FROM customer WHERE NOT (c_mktsegment = 'MACHINERY' AND c_nationkey = 4)",
)
def store_update_one(spark, sf):
    """One condition map for an update, another for a delete."""
    changed = tb.update_where(
        fx.table(spark, sf, "customer"), {"c_acctbal": 0.0}, {"c_mktsegment": "BUILDING", "c_nationkey": 3}
    )
    return tb.delete_where(changed, {"c_mktsegment": "MACHINERY", "c_nationkey": 4}).select("c_custkey", "c_acctbal")


@add("retention_purge", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def retention_purge(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "ts")
    return tb.purge_older(events, "ts", F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'"))


@add("retention_purge_applied", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def retention_purge_applied(spark, sf):
    """The purge as DELETE changes, folded at a destination."""
    events = fx.table(spark, sf, "events").select("event_id", "ts", "event_type")
    spec = TableSpec.of("events", events, "event_id")
    same = {"device_id": "d", "device_name": "d"}
    loaded = as_changes(
        events, spec, **same, op=INSERT, segment=0, seq=F.col("event_id"), commit_id=fx.commit_id(0, F.col("event_id"))
    )
    purge = tb.purge_changes(
        events, spec, "ts", F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'"), **same, segment=1, commit_id=fx.commit_id(1, F.lit(0))
    )
    return fold(loaded.unionByName(purge), spec, (INSERT, "DELETE")).select("event_id", "event_type")


@add(
    "append_only_split",
    f"WITH {cf.orders_log()} SELECT CASE WHEN op = 'INSERT' THEN 'accepted' ELSE 'rejected' END AS verdict, op, "
    "count(*) AS n FROM log GROUP BY 1, 2",
)
def append_only_split(spark, sf):
    accepted, rejected = tb.split_appends(fx.orders_log(spark, sf))
    both = accepted.select(F.lit("accepted").alias("verdict"), F.col("_op").alias("op")).unionByName(
        rejected.select(F.lit("rejected").alias("verdict"), F.col("_op").alias("op"))
    )
    return both.groupBy("verdict", "op").agg(F.count("*").alias("n"))


# -- key-value state ----------------------------------------------------------------------------

#: Last value per user, and whether its deadlines have passed: after it each error gives an hour, unless the hour before has run out by then.
STRINGS = """s AS (SELECT user_id, max(event_id) AS at, arg_max(value, event_id) AS v FROM events WHERE event_type = 'view' GROUP BY 1),
    x AS (SELECT e.user_id, bool_and(e.ts + INTERVAL 3600 SECOND > coalesce(e.later, TIMESTAMP '2024-02-01 00:00:00')) AS alive
      FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS later FROM events WHERE event_type = 'error') e
      JOIN s ON e.user_id = s.user_id AND e.event_id > s.at GROUP BY 1),
    live AS (SELECT s.user_id, v FROM s LEFT JOIN x ON s.user_id = x.user_id WHERE coalesce(alive, true))"""


@add("kv_strings", f"WITH {STRINGS} SELECT 'user:' || user_id AS \"key\", v AS \"value\" FROM live")
def kv_strings(spark, sf):
    """Live string keys after expiry."""
    state = kv.strings(fx.kv_events(spark, sf), fx.kv_as_of())
    return state.select("key", F.col("value").cast("double").alias("value"))


@add(
    "kv_strings_unexpired",
    f"WITH {STRINGS.replace("coalesce(e.later, TIMESTAMP '2024-02-01 00:00:00')", "coalesce(e.later, e.ts)")} "
    "SELECT 'user:' || user_id AS \"key\", v AS \"value\" FROM live",
)
def kv_strings_unexpired(spark, sf):
    """Without an instant only calls can find that a deadline has passed."""
    return kv.strings(fx.kv_events(spark, sf)).select("key", F.col("value").cast("double").alias("value"))


@add("kv_get", f"WITH {STRINGS} SELECT 'user:' || c_custkey AS \"key\", v AS \"value\" FROM customer LEFT JOIN live ON c_custkey = user_id")
def kv_get(spark, sf):
    keys = fx.table(spark, sf, "customer").select(F.concat(F.lit("user:"), F.col("c_custkey")).alias("key"))
    return kv.get(fx.kv_events(spark, sf), keys, fx.kv_as_of()).select("key", F.col("value").cast("double").alias("value"))


#: Walks each user's events in order: whether the session lives, until when, and since which event.
SESSIONS = """WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
    s AS (
      SELECT user_id, 0::BIGINT AS rn, false AS alive, NULL::TIMESTAMP AS deadline, NULL::BIGINT AS born FROM events GROUP BY user_id
      UNION ALL
      SELECT user_id, rn, CASE event_type WHEN 'signup' THEN false WHEN 'error' THEN live ELSE true END,
        CASE WHEN NOT live OR event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN ts + INTERVAL 2 DAY ELSE deadline END,
        CASE WHEN live OR event_type IN ('signup', 'error') THEN born ELSE event_id END
      FROM (SELECT e.*, s.alive AND coalesce(s.deadline > e.ts, true) AS live, s.deadline, s.born FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1)
    ),
    z AS (SELECT user_id, arg_max(born, rn) AS born FROM s GROUP BY 1
      HAVING arg_max(alive AND coalesce(deadline > TIMESTAMP '2024-02-01 00:00:00', true), rn)),
    w AS (SELECT 'session:' || e.user_id AS "key", e.* FROM e JOIN z ON e.user_id = z.user_id AND event_id >= born)
    SELECT 'hash' AS kind, "key", (event_id % 5)::VARCHAR AS item, arg_max(value, event_id) AS "value" FROM w WHERE event_type = 'click' GROUP BY ALL
    UNION ALL SELECT 'list', "key", (row_number() OVER (PARTITION BY "key" ORDER BY event_id))::VARCHAR, event_id::DOUBLE FROM w WHERE event_type = 'purchase'
    UNION ALL SELECT DISTINCT 'set', "key", (event_id % 7)::VARCHAR, NULL::DOUBLE FROM w WHERE event_type = 'view'"""


@add("kv_write_after_expiry", SESSIONS)
def kv_write_after_expiry(spark, sf):
    """Everything alive in keys that die by deadline or deletion and live again from their next write on."""
    state = kv.full_state(fx.kv_sessions(spark, sf), fx.kv_as_of())
    return state.select("kind", "key", "item", F.col("value").cast("double").alias("value"))


HASH_ALIVE = (
    "e AS (SELECT * FROM events), "
    "d AS (SELECT user_id, max(event_id) AS del FROM e WHERE event_type = 'signup' GROUP BY 1)"
)


@add(
    "kv_hashes",
    f"WITH {HASH_ALIVE} SELECT 'h:' || e.user_id AS \"key\", (event_id % 5)::VARCHAR AS field, "
    "arg_max(value, event_id) AS \"value\" FROM e LEFT JOIN d ON e.user_id = d.user_id "
    "WHERE event_type = 'click' AND (del IS NULL OR event_id > del) GROUP BY 1, 2",
)
def kv_hashes(spark, sf):
    return kv.hashes(fx.kv_events(spark, sf), fx.kv_as_of()).select("key", "field", F.col("value").cast("double").alias("value"))


@add(
    "kv_lists",
    "SELECT 'q:' || user_id AS \"key\", row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS position, "
    f"event_id::VARCHAR AS \"value\" FROM events WHERE event_type = 'purchase'",
)
def kv_lists(spark, sf):
    return kv.lists(fx.kv_events(spark, sf), fx.kv_as_of())


@add(
    "kv_sets",
    f"SELECT DISTINCT 's:' || user_id AS \"key\", (event_id % 7)::VARCHAR AS member FROM events "
    "WHERE event_type = 'click'",
)
def kv_sets(spark, sf):
    return kv.sets(fx.kv_events(spark, sf), fx.kv_as_of())


BOARD = (
    f"SELECT user_id::VARCHAR AS member, arg_max(value, event_id) AS score FROM events "
    "WHERE event_type = 'purchase' GROUP BY 1"
)


@add(
    "kv_sorted_sets",
    f"SELECT 'board' AS \"key\", row_number() OVER (ORDER BY score, member) AS rank, member, score FROM ({BOARD})",
)
def kv_sorted_sets(spark, sf):
    """One key holds all members: ranked across partitions, not in one task."""
    return kv.sorted_sets(fx.kv_events(spark, sf), fx.kv_as_of())


@add(
    "kv_full_state",
    f"WITH {HASH_ALIVE}, {STRINGS} SELECT 'hash' AS kind, count(DISTINCT (e.user_id, event_id % 5)) AS n FROM e "
    "LEFT JOIN d ON e.user_id = d.user_id WHERE event_type = 'click' AND (del IS NULL OR event_id > del) "
    "UNION ALL SELECT 'string', count(*) FROM live "
    "UNION ALL SELECT 'list', count(*) FROM e WHERE event_type = 'purchase' "
    "UNION ALL SELECT 'set', count(DISTINCT (user_id, event_id % 7)) FROM e WHERE event_type = 'click' "
    "UNION ALL SELECT 'zset', count(DISTINCT user_id) FROM e WHERE event_type = 'purchase'",
)
def kv_full_state(spark, sf):
    return kv.full_state(fx.kv_events(spark, sf), fx.kv_as_of()).groupBy("kind").agg(F.count("*").alias("n"))
