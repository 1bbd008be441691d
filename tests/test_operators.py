"""Carry, ranking, modes, key-value, evolution helpers, validation: against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from deltaloom.model import DELETE, INSERT, LIFECYCLE_OPS, ROW_OPS, UPDATE, TableSpec, common_type
from deltaloom.operators import evolve, modes, query, ranking, tables, validate
from deltaloom.operators import keyvalue as kv
from deltaloom.operators import normalize as nz
from deltaloom.operators.carry import carry_forward, fill_statements
from test_fold import LOG, random_log, simulate, spec_of
from test_replay import log_of


def test_carry_across_small_chunks(spark):
    rnd = random.Random(3)
    rows = [("d", "n", s, q, 0, rnd.choice([None, None, None, s * 1000 + q])) for s in range(3) for q in range(200)]
    df = spark.createDataFrame(rows, "_device_id string, _device_name string, _segment bigint, _seq bigint, _txn_seq bigint, v bigint")
    for inclusive in (True, False):
        got = carry_forward(df, ["_device_id"], F.col("v"), "last", inclusive, chunk_rows=7)
        last, want = None, {}
        for _, _, s, q, _, v in rows:
            if inclusive and v is not None:
                last = v
            want[s, q] = last
            if v is not None:
                last = v
        assert {(r["_segment"], r["_seq"]): r["last"] for r in got.collect()} == want


def test_carry_inside_one_large_transaction(spark):
    rnd = random.Random(4)
    rows = [("d", "n", 0, q, t, rnd.choice([None, None, q * 1000 + t])) for q in range(3) for t in range(100)]
    df = spark.createDataFrame(rows, "_device_id string, _device_name string, _segment bigint, _seq bigint, _txn_seq bigint, v bigint")
    got = carry_forward(df, ["_device_id"], F.col("v"), "last", True, chunk_rows=9, transactions=True)
    last, want = None, {}
    for _, _, _, q, t, v in rows:
        last = v if v is not None else last
        want[q, t] = last
    assert {(r["_seq"], r["_txn_seq"]): r["last"] for r in got.collect()} == want


def test_statements_do_not_leak_into_the_next_segment(spark):
    rows = [("d", "n", s, q, 0, 0, "A" if (s, q) == (0, 1) else "", []) for s in (0, 1) for q in (1, 2, 30)]
    log = spark.createDataFrame(
        rows, "_device_id string, _device_name string, _segment bigint, _seq bigint, _txn_seq bigint, _commit_id bigint, sql string, args array<binary>"
    )
    got = {(r["_segment"], r["_seq"]): r["sql"] for r in fill_statements(log, chunk_rows=5).collect()}
    assert got == {(0, 1): "A", (0, 2): "A", (0, 30): "A", (1, 1): None, (1, 2): None, (1, 30): None}


def test_numbering_one_large_group(spark):
    rows = [("big" if i % 3 else "small", i * 7919 % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {(r["g"], r["v"]): r["nr"] for r in ranking.number_rows(df, ["g"], ["v"], "nr").collect()}
    for group in ("big", "small"):
        values = sorted(v for g, v in rows if g == group)
        assert [got[group, v] for v in values] == list(range(1, len(values) + 1))


@pytest.mark.parametrize("seed", [4, 5])
def test_conflicts_and_insert_mode(spark, seed):
    log = random_log(seed, keys=15, rows=400)
    spec = spec_of(spark)
    alive, want, kept = set(), [], []
    for r in log:
        at, op = (r[0], r[8]), r[6]
        if op == INSERT and at in alive:
            want.append((r[3], "insert_existing"))
        elif op == UPDATE and at not in alive:
            want.append((r[3], "update_missing"))
        elif op == DELETE and at not in alive:
            want.append((r[3], "delete_missing"))
        if not (op == INSERT and at in alive):
            kept.append(r)
        if op in LIFECYCLE_OPS:
            (alive.discard if op == DELETE else alive.add)(at)
    df = spark.createDataFrame(log + log[:50], LOG)
    assert sorted((r["_seq"], r["kind"]) for r in modes.conflicts(df, spec).collect()) == sorted(want)
    got = modes.apply_mode(df, spec, INSERT)
    from test_fold import as_dict

    from deltaloom.operators.fold import fold

    assert as_dict(fold(got, spec)) == simulate(kept)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        modes.apply_mode(spark.createDataFrame([], LOG), spec_of(spark), "MERGE")


@pytest.mark.parametrize("seed", [9, 10])
def test_key_value_log_against_a_dictionary(spark, seed):
    """Keys die by deletion and deadline and live again; positions are far apart, so calls of a key stand in many chunks."""
    rnd = random.Random(seed)
    rows, strings, hashes, lists, sets_, boards = [], {}, {}, {}, {}, {}
    states = (strings, hashes, lists, sets_, boards)
    expiry, alive = {}, set()

    def forget(key):
        for state in (*states, expiry):
            state.pop(key, None)
        alive.discard(key)

    for n in range(900):
        key = rnd.choice([*(f"k{i}" for i in range(12)), None])
        call = rnd.choice(["set", "hset", "rpush", "sadd", "zadd", "del", "expire", "expire"])
        row = {"ord": n * 30_011, "ts": n, "call": call, "key": key}
        if expiry.get(key, n + 1) <= n:
            forget(key)
        if call not in ("del", "expire"):
            alive.add(key)
        if call == "set":
            row["value"] = strings[key] = f"v{n}"
            expiry.pop(key, None)
        elif call == "hset":
            row["fields"] = {f"f{rnd.randrange(3)}": f"h{n}"}
            hashes.setdefault(key, {}).update(row["fields"])
        elif call == "rpush":
            row["members"] = [f"a{n}", f"b{n}"]
            lists.setdefault(key, []).extend(row["members"])
        elif call == "sadd":
            row["members"] = [f"m{rnd.randrange(4)}"]
            sets_.setdefault(key, set()).update(row["members"])
        elif call == "zadd":
            row["scores"] = {f"p{rnd.randrange(4)}": float(rnd.randrange(3))}
            boards.setdefault(key, {}).update(row["scores"])
        elif call == "del":
            forget(key)
        else:
            row["ttl"] = rnd.choice([0, 5, 30, 60, 200, 10_000])
            if key in alive:
                expiry[key] = n + row["ttl"]
        rows.append(row)
    schema = kv.LOG_SCHEMA.simpleString().replace("ts:timestamp_ntz", "ts:bigint")
    raw = spark.createDataFrame([tuple(r.get(f.name) for f in kv.LOG_SCHEMA.fields) for r in rows], schema)
    start = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")
    log = raw.withColumn("ts", F.timestamp_add("SECOND", F.col("ts"), start))
    gone = {k for k, at in expiry.items() if at <= 950}
    assert gone and set(expiry) - gone
    as_of = F.timestamp_add("SECOND", F.lit(950), start)

    def live(state):
        return {k: v for k, v in state.items() if k not in gone}

    assert {r["key"]: r["value"] for r in kv.strings(log, as_of).collect()} == live(strings)
    assert {r["key"]: r["value"] for r in kv.strings(log).collect()} == strings
    got = {}
    for r in kv.hashes(log, as_of).collect():
        got.setdefault(r["key"], {})[r["field"]] = r["value"]
    assert got == live(hashes)
    got = {}
    for r in kv.lists(log, as_of).orderBy("key", "position").collect():
        got.setdefault(r["key"], []).append(r["value"])
    assert got == live(lists)
    got = {}
    for r in kv.sets(log, as_of).collect():
        got.setdefault(r["key"], set()).add(r["member"])
    assert got == live(sets_)
    got = {}
    for r in kv.sorted_sets(log, as_of).orderBy("key", "rank").collect():
        got.setdefault(r["key"], []).append((r["score"], r["member"]))
    assert got == {k: sorted((s, m) for m, s in v.items()) for k, v in live(boards).items()}


@pytest.mark.parametrize(
    "left,right,want",
    [
        ("int", "bigint", "bigint"),
        ("bigint", "double", "double"),
        ("double", "string", "string"),
        ("float", "double", "double"),
        ("date", "timestamp", "timestamp"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("binary", "int", None),
        ("boolean", "string", None),
    ],
)
def test_widening(left, right, want):
    assert common_type(left, right) == want == common_type(right, left)


def test_union_of_evolving_frames_refuses_unrelated_types(spark):
    a = spark.createDataFrame([(1, b"x")], "id int, v binary")
    b = spark.createDataFrame([(2, 5)], "id bigint, v int")
    with pytest.raises(ValueError, match="no common type"):
        evolve.union_evolving(a, b)


def test_ddl_shapes(spark):
    log = log_of(
        spark,
        [
            'CREATE TABLE IF NOT EXISTS "t" (id INTEGER, name VARCHAR(20) NOT NULL, PRIMARY KEY (id, name));',
            "alter table t add email TEXT",
            "ALTER TABLE t ALTER COLUMN id TYPE REAL",
            "ALTER TABLE t RENAME TO u",
            "ALTER TABLE t ADD CONSTRAINT",
        ],
    )
    rows = evolve.read_ddl(log).orderBy("_seq").collect()
    assert [(r["_op"], r["_table"], r["_column"], r["_type"], r["_to"]) for r in rows[:4]] == [
        ("CREATE_TABLE", "t", None, None, None),
        ("ADD_COLUMN", "t", "email", "TEXT", None),
        ("WIDEN_COLUMN", "t", "id", "REAL", None),
        ("RENAME_TABLE", "t", None, None, "u"),
    ]
    assert [(c["name"], c["type"]) for c in rows[0]["_columns"]] == [("id", "INTEGER"), ("name", "VARCHAR")]
    assert list(rows[0]["_keys"]) == ["id", "name"]


def test_column_mapping_maps_the_assigned_columns(spark):
    df = spark.createDataFrame([("d", "n", 0, 0, 0, 0, UPDATE, ["a", "b"], 1, "x", 2)], LOG)
    row = nz.map_columns(df, {"a": "alpha"}, ["b"]).first()
    assert row["_set_cols"] == ["alpha"] and row["alpha"] == "x" and "b" not in row.asDict()


def test_comparing_a_table_with_itself_is_empty(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    assert validate.compare_rows(orders, orders, ["o_orderkey"]).count() == 0
    assert validate.difference_report(orders, orders, ["o_orderkey"]).count() == 0
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    assert validate.compare_bags(lines, lines.orderBy("l_tax")).count() == 0


def test_nulls_and_nested_values_are_compared(spark):
    schema = "id int, a string, m map<string,int>, l array<float>"
    s = spark.createDataFrame([(1, None, {"x": 1}, [1.0]), (2, "b", {"x": 1}, [1.0])], schema)
    d = spark.createDataFrame([(1, None, {"x": 1}, [1.0]), (2, None, {"x": 2}, [2.0])], schema)
    report = validate.difference_report(s, d, ["id"]).collect()
    assert {(r["id"], r["column_name"]) for r in report} == {(2, "a"), (2, "m"), (2, "l")}
    assert validate.fingerprint(s).first() != validate.fingerprint(d).first()


def test_pages_cover_the_table_once(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(25)], "id bigint, v string")
    seen, after, more = [], None, True
    while more:
        rows = query.page(df, "id", 10, after).orderBy("id").collect()
        seen += [r["id"] for r in rows]
        after, more = seen[-1], rows[0]["has_more"]
    assert seen == list(range(25))


def test_result_metadata_and_tables(spark):
    spec, empty = tables.create_table(spark, "players", {"id": "INTEGER PRIMARY KEY", "name": "TEXT", "score": "INTEGER"})
    assert spec.keys == ("id",) and query.column_metadata(empty)[0] == {"label": "id", "type": "BIGINT"}
    rows = spark.createDataFrame([(1, "Alice", 100), (2, "Bob", 200), (3, "Carol", 300)], empty.schema)
    table = tables.insert_rows(empty, rows)
    table = tables.update_where(table, {"score": 250, "level": 7}, {"name": "Bob"})
    table = tables.delete_where(table, {"id": 3})
    assert sorted(tuple(r) for r in table.collect()) == [(1, "Alice", 100, None), (2, "Bob", 250, 7)]
    with pytest.raises(ValueError, match="both assigned and matched"):
        tables.update_each(table, spark.createDataFrame([(1, 2)], "id bigint, set_id bigint"), ["id"], F.lit(1))


def test_include_and_exclude(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "_table string")
    assert sorted(r[0] for r in nz.only_tables(df, ["a", "b"], ["b"]).collect()) == ["a"]
    assert sorted(r[0] for r in nz.only_tables(df, (), ["b"]).collect()) == ["a", "c"]


def test_key_columns_must_exist(spark):
    with pytest.raises(ValueError):
        TableSpec("t", spark.createDataFrame([], "a int").schema, ("b",))
    assert len(ROW_OPS) == 5


def test_key_values_at_an_instant(spark):
    """Calls from the instant on do not count, neither as values nor as deletions nor as what clears an expiry."""
    rows = [(1, 10, "set", "a", "1"), (2, 20, "set", "a", "2"), (3, 30, "del", "a", None), (4, 20, "set", "b", "3"), (5, 5, "set", "c", "4")]
    raw = spark.createDataFrame(rows, "ord long, at long, call string, key string, value string")
    ts = (F.timestamp_seconds("at")).cast("timestamp_ntz")
    log = kv.kv_log(raw, ord=F.col("ord"), ts=ts, call=F.col("call"), key=F.col("key"), value=F.col("value"))
    expiry = spark.createDataFrame([(6, 6, "expire", "c", 5), (7, 21, "set", "c", 0)], "ord long, at long, call string, key string, ttl long")
    log = log.unionByName(kv.kv_log(expiry, ord=F.col("ord"), ts=ts, call=F.col("call"), key=F.col("key"), ttl=F.col("ttl")))
    as_of = F.timestamp_seconds(F.lit(20)).cast("timestamp_ntz")
    assert {r["key"]: r["value"] for r in kv.strings(log, as_of).collect()} == {"a": "1"}
    assert {r["key"]: r["value"] for r in kv.strings(log).collect()} == {"b": "3", "c": None}


def test_key_value_events_are_not_cut(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    assert fx.kv_events(spark, sf).where("ord % 2 = 0").count() == events.count()


def test_comparison_by_buckets(spark):
    """The same differences as the join of whole tables, with null keys, nested values and missing rows."""
    rnd = random.Random(5)
    rows = [(i if i % 50 else None, f"a{i % 7}", [i, None], float("nan") if i % 9 == 0 else i / 3) for i in range(1, 500)]
    rows = [r for r in rows if r[0] is not None] + [(None, "x", None, None)]
    other = [r if rnd.random() > 0.05 else (r[0], "changed", r[2], r[3]) for r in rows if rnd.random() > 0.03] + [(1000 + i, "new", [], 0.0) for i in range(5)]
    schema = "id bigint, a string, b array<bigint>, c double"
    s, d = spark.createDataFrame(rows, schema).repartition(3), spark.createDataFrame(other, schema).select("c", "b", "a", "id")
    plain = lambda df: sorted(map(str, df.collect()))
    expected = plain(validate.compare_rows(s, d, ["id"]))
    assert expected and plain(validate.compare_by_buckets(s, d, ["id"], 64)) == expected
    assert validate.compare_by_buckets(s, s.repartition(5), ["id"]).count() == 0
    assert plain(validate.compare_by_buckets(s, s.limit(0), ["id"])) == plain(validate.compare_rows(s, s.limit(0), ["id"]))


def test_a_hundred_thousand_field_names(spark):
    rows = spark.range(100_000).selectExpr("id", """concat('{"f', id, '":', id, ',"often":"', id % 3, '","it\\'s":1.5}') AS j""")
    wide = evolve.add_json_columns(rows, "j", {"often": "bigint"}, most=10)
    assert len(wide.columns) == 12 and {"often", "it's", "_rest"} <= set(wide.columns)
    r = wide.where("id = 70001").first()
    assert (r["often"], r["it's"], r["_rest"].toPython()["f70001"]) == (2, "1.5", 70001)
    few = evolve.add_json_columns(rows.limit(3), "j")
    assert "_rest" not in few.columns and [tuple(x) for x in few.select("f1", "often").orderBy("id").collect()] == [(None, "0"), ("1", "1"), (None, "2")]


def test_lives_of_keys_are_found_once_for_all_kinds(spark, monkeypatch):
    calls, found = [], kv.key_states
    monkeypatch.setattr(kv, "key_states", lambda *a: calls.append(1) or found(*a))
    ts = F.timestamp_seconds("ord").cast("timestamp_ntz")
    raw = spark.createDataFrame([(1, "set", "a", "x"), (2, "set", "b", "y"), (3, "del", "a", None), (4, "set", "a", "z"), (5, "del", "b", None)], "ord long, call string, key string, value string")
    log = kv.kv_log(raw, ord=F.col("ord"), ts=ts, call=F.col("call"), key=F.col("key"), value=F.col("value"))
    assert [tuple(r) for r in kv.full_state(log).collect()] == [("string", "a", None, "z")]
    assert len(calls) == 1
