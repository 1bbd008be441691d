"""Command logs with known end states: DDL, batches, bulk updates, both sync modes."""

import pytest
from pyspark.sql import functions as F

from deltaloom.operators.evolve import CONSOLIDATION, REPLICATION
from deltaloom.operators.normalize import deduce_changes, unrecognised
from deltaloom.plans.replay import replay_commands

LOG = (
    "_device_id string, _device_name string, _segment bigint, _seq bigint, _txn_seq bigint, _commit_id bigint,"
    " sql string, args array<binary>"
)


def log_of(spark, statements, device="d1"):
    rows = []
    for n, entry in enumerate(statements, 1):
        text, args = entry if isinstance(entry, tuple) else (entry, [])
        data = [None if a is None else bytearray(str(a).encode()) for a in args]
        rows.append((device, "n" + device, 0, n, 0, 1000 + n, text, data))
    return spark.createDataFrame(rows, LOG)


def rows_of(result, *columns):
    return sorted((tuple(r[c] for c in columns) for r in result.rows.collect()), key=str)


GAUGES = [
    "DROP TABLE IF EXISTS gauges",
    "CREATE TABLE gauges (serial INTEGER PRIMARY KEY, room TEXT, bar REAL, checks INTEGER)",
    ("INSERT INTO gauges (serial, room, bar, checks) VALUES (?, ?, ?, ?)", [70, "cellar", 0.5, 1]),
    ("", [71, "attic", 1.25, 1]),
    ("", [72, "cellar", 2.75, 0]),
    ("UPDATE gauges SET checks = ? WHERE room = ?", [8, "cellar"]),
    ("INSERT INTO gauges (serial, room, bar, checks) VALUES (?, ?, ?, ?)", [73, "cellar", 3.0, 0]),
]
VALVES = [
    "CREATE TABLE valves (code INTEGER PRIMARY KEY, turns REAL)",
    ("INSERT INTO valves (code, turns) VALUES (?, ?)", [4, 0.25]),
    "ALTER TABLE valves RENAME COLUMN turns TO quarter_turns",
    ("INSERT INTO valves (code, quarter_turns) VALUES (?, ?)", [5, 3.5]),
    "ALTER TABLE valves ADD COLUMN maker TEXT",
    ("INSERT INTO valves (code, quarter_turns, maker) VALUES (?, ?, ?)", [6, 7.0, "north"]),
    ("UPDATE valves SET maker = ? WHERE code = ?", ["south", 4]),
    "ALTER TABLE valves DROP COLUMN maker",
]
SHIFTS = [
    "CREATE TABLE shifts (day INTEGER, crew TEXT, hours INTEGER, PRIMARY KEY (day, crew))",
    ("INSERT INTO shifts (day, crew, hours) VALUES (?, ?, ?)", [1, "red", 8]),
    ("INSERT INTO shifts (day, crew, hours) VALUES (?, ?, ?)", [1, "blue", 6]),
    "ALTER TABLE shifts RENAME TO old_shifts",
    ("INSERT INTO old_shifts (day, crew, hours) VALUES (?, ?, ?)", [2, "red", 4]),
    ("DELETE FROM old_shifts WHERE day = ? AND crew = ?", [2, "blue"]),
]


def test_update_by_another_column_and_batch(spark):
    want = [(70, "cellar", 0.5, 8), (71, "attic", 1.25, 1), (72, "cellar", 2.75, 8), (73, "cellar", 3.0, 0)]
    for mode in (REPLICATION, CONSOLIDATION):
        assert rows_of(replay_commands(log_of(spark, GAUGES), "gauges", mode), "serial", "room", "bar", "checks") == want


def test_columns_renamed_added_and_dropped_in_replication(spark):
    result = replay_commands(log_of(spark, VALVES), "valves", REPLICATION)
    assert result.spec.columns == ["code", "quarter_turns"] and result.spec.keys == ("code",)
    assert rows_of(result, "code", "quarter_turns") == [(4, 0.25), (5, 3.5), (6, 7.0)]


def test_columns_renamed_added_and_dropped_in_consolidation(spark):
    result = replay_commands(log_of(spark, VALVES), "valves", CONSOLIDATION)
    assert set(result.spec.columns) == {"code", "turns", "quarter_turns", "maker"}
    assert result.rows.columns[:3] == ["sys_device_id", "sys_device_name", "sys_update_ts"]
    assert rows_of(result, "code", "turns", "quarter_turns", "maker") == [
        (4, 0.25, None, "south"),
        (5, None, 3.5, None),
        (6, None, 7.0, "north"),
    ]
    assert [(r["op"], r["table_name"]) for r in result.ignored.collect()] == [("DROP_COLUMN", "valves")]


def test_renamed_table(spark):
    log = log_of(spark, SHIFTS)
    moved = replay_commands(log, "old_shifts", REPLICATION)
    assert rows_of(moved, "day", "crew", "hours") == [(1, "blue", 6), (1, "red", 8), (2, "red", 4)]
    with pytest.raises(ValueError, match="does not exist"):
        replay_commands(log, "shifts", REPLICATION)
    assert rows_of(replay_commands(log, "shifts", CONSOLIDATION), "day", "crew", "hours") == [(1, "blue", 6), (1, "red", 8)]
    assert rows_of(replay_commands(log, "old_shifts", CONSOLIDATION), "day", "crew", "hours") == [(2, "red", 4)]


BADGES = [
    "CREATE TABLE badges (no INTEGER PRIMARY KEY, holder TEXT)",
    ("INSERT INTO badges (no, holder) VALUES (?, ?)", [31, "Ngozi"]),
    (None, [32, "Tomek"]),
    (None, [33, "Aiko"]),
    "ALTER TABLE badges ADD COLUMN gate INTEGER",
    ("DELETE FROM badges WHERE no = ?", [32]),
    ("UPDATE badges SET gate = ?, holder = ? WHERE no = ?", [2, "Ngozi O.", 31]),
    "DROP TABLE badges",
]


def test_a_table_from_create_to_drop(spark):
    before = replay_commands(log_of(spark, BADGES[:-1]), "badges", REPLICATION)
    assert before.spec.columns == ["no", "holder", "gate"]
    assert rows_of(before, "no", "holder", "gate") == [(31, "Ngozi O.", 2), (33, "Aiko", None)]
    with pytest.raises(ValueError, match="does not exist"):
        replay_commands(log_of(spark, BADGES), "badges", REPLICATION)


def test_long_literals_and_wide_statements(spark):
    from deltaloom.model import TableSpec

    long, plain, wide = "it''s " * 200_000, "it's " * 200_000, ", ".join(f"c{i} = {i}" for i in range(2000))
    schema = "id bigint, a string, " + ", ".join(f"c{i} int" for i in range(2000))
    spec = TableSpec("t", spark.createDataFrame([], schema).schema, ("id",))
    log = [
        f"INSERT INTO t (id, a) VALUES (1, '{long}')",
        f'UPDATE "main"."t" SET a = \'{long}!\' WHERE id = 2',
        f"DELETE FROM main.t WHERE a = '{long}?'",
        f"UPDATE t SET {wide} WHERE id = 0",
        f"INSERT INTO t VALUES ({', '.join(['7'] * 2002)})",
    ]
    rows = deduce_changes(log_of(spark, log), [spec]).orderBy("_seq").select("_op", "_table", "_set", "_where", "_problem").collect()
    assert [(r["_op"], r["_table"], r["_problem"]) for r in rows] == [(op, "t", None) for op in ("INSERT", "UPDATE", "DELETE_WHERE", "UPDATE", "INSERT")]
    assert rows[0]["_set"]["a"].decode() == plain and rows[1]["_set"]["a"].decode() == plain + "!" and rows[2]["_where"]["a"].decode() == plain + "?"
    assert len(rows[3]["_set"]) == 2000 and rows[3]["_set"]["c1999"] == b"1999" and len(rows[4]["_set"]) == 2002


def test_readded_column_does_not_show_old_values(spark):
    log = [
        "CREATE TABLE t (id INTEGER PRIMARY KEY, a TEXT)",
        ("INSERT INTO t VALUES (?, ?)", [1, "old"]),
        "ALTER TABLE t DROP COLUMN a",
        "ALTER TABLE t ADD COLUMN a TEXT",
        ("INSERT INTO t VALUES (?, ?)", [2, "new"]),
        "ALTER TABLE t RENAME COLUMN a TO b",
        "ALTER TABLE t ADD COLUMN a INTEGER",
        ("INSERT INTO t (id, b, a) VALUES (3, 'lit''eral', 7)", []),
        ("UPDATE t SET b = NULL WHERE id = 2", []),
    ]
    result = replay_commands(log_of(spark, log), "t", REPLICATION)
    assert rows_of(result, "id", "b", "a") == [(1, None, None), (2, None, None), (3, "lit'eral", 7)]


def test_devices_do_not_touch_each_other(spark):
    bulk = GAUGES[1:4] + [("DELETE FROM gauges WHERE bar >= ?", [1])]
    log = log_of(spark, bulk).unionByName(log_of(spark, GAUGES[1:4], "d2"))
    result = replay_commands(log, "gauges", CONSOLIDATION)
    assert rows_of(result, "sys_device_id", "serial") == [("d1", 70), ("d2", 70), ("d2", 71)]


def test_truncate_upsert_replace_and_delete_all(spark):
    log = [
        "CREATE TABLE t (id INTEGER PRIMARY KEY, a TEXT, b INTEGER)",
        ("INSERT INTO t VALUES (?, ?, ?)", [1, "x", 1]),
        "DELETE FROM t",
        ("INSERT INTO t (id, a) VALUES (?, ?) ON CONFLICT (id) DO UPDATE SET a = excluded.a", [2, "up"]),
        ("INSERT INTO t (id, b) VALUES (?, ?) ON CONFLICT (id) DO UPDATE SET b = excluded.b", [2, 5]),
        ("INSERT INTO t (id, a, b) VALUES (?, ?, ?)", [3, "y", 3]),
        ("REPLACE INTO t (id, a) VALUES (?, ?)", [3, "z"]),
    ]
    result = replay_commands(log_of(spark, log), "t", REPLICATION)
    assert rows_of(result, "id", "a", "b") == [(2, "up", 5), (3, "z", None)]


def test_what_cannot_be_deduced_is_reported(spark):
    log = log_of(
        spark,
        [
            "CREATE TABLE t (id INTEGER PRIMARY KEY, a INTEGER)",
            "UPDATE t SET a = a + 1 WHERE id = 1",
            ("UPDATE t SET id = ? WHERE id = ?", [2, 1]),
            "VACUUM",
            ("INSERT INTO nowhere (id) VALUES (?)", [1]),
            ("INSERT INTO t (id, a) VALUES (?)", [1]),
        ],
    )
    result = replay_commands(log, "t", REPLICATION)
    found = {r["_seq"]: r["_problem"] for r in result.rejected.collect()}
    assert found == {
        2: "assigned values are expressions",
        3: "key-changing update with a partial image",
        4: "statement shape not recognised",
        5: "unknown table",
        6: "column and value counts differ",
    }
    assert result.rows.count() == 0


def test_bulk_terms_follow_a_renamed_column(spark):
    log = [
        "CREATE TABLE t (id INTEGER PRIMARY KEY, a INTEGER, b TEXT)",
        ("INSERT INTO t VALUES (?, ?, ?)", [1, 10, "p"]),
        ("", [2, 20, "p"]),
        ("UPDATE t SET b = ? WHERE a > ?", ["big", 15]),
        "ALTER TABLE t RENAME COLUMN a TO c",
        ("DELETE FROM t WHERE c = ?", [10]),
    ]
    result = replay_commands(log_of(spark, log), "t", REPLICATION)
    assert rows_of(result, "id", "c", "b") == [(2, 20, "big")]


def test_missing_arguments_read_as_null(spark):
    log = ["CREATE TABLE t (id INTEGER PRIMARY KEY, a TEXT)", ("INSERT INTO t (id, a) VALUES (?, ?)", [1])]
    assert rows_of(replay_commands(log_of(spark, log), "t", REPLICATION), "id", "a") == [(1, None)]


def test_deduction_keeps_set_and_where_apart(spark):
    from deltaloom.model import TableSpec

    spec = TableSpec("t", spark.createDataFrame([], "id bigint, a string").schema, ("id",))
    log = log_of(spark, [("UPDATE t SET a = ? WHERE a = 'x' AND id = ?", ["y", 1])])
    row = deduce_changes(log, [spec]).select(
        "_op", F.col("_set")["a"].cast("string").alias("s"), F.col("_where")["a"].cast("string").alias("w")
    ).first()
    assert (row["_op"], row["s"], row["w"]) == ("UPDATE_WHERE", "y", "x")
    assert unrecognised(deduce_changes(log, [spec])).count() == 0


REFUSED = [
    "CREATE TABLE gauges (serial INTEGER PRIMARY KEY, bar REAL)",
    "INSERT INTO gauges (serial, bar) VALUES (1, 0.5), (2, 1.5)",
    "UPDATE gauges SET bar = bar + 1 WHERE serial = 1",
    "ALTER TABLE gauges ADD COLUMN room TEXT",
    ("INSERT INTO gauges (serial, bar, room) VALUES (?, ?, ?)", [3, 2.5, "attic"]),
]


@pytest.mark.parametrize("hold", [False, True])
def test_a_command_log_is_read_and_deduced_once(spark, monkeypatch, hold):
    from deltaloom.plans import replay

    read, limits = spark.sparkContext.accumulator(0), []

    def seen(text):
        read.add(1)
        return text

    def deduce(log):
        limits.append(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
        return deduce_changes(log)

    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    monkeypatch.setattr(replay, "deduce_changes", deduce)
    log = log_of(spark, REFUSED).unionByName(log_of(spark, REFUSED[:2] + REFUSED[3:], "d2"))
    log = log.withColumn("sql", F.udf(seen).asNondeterministic()("sql"))
    result = replay_commands(log, "gauges", CONSOLIDATION, filled=True, hold_refused=hold)
    rows = rows_of(result, "sys_device_id", "serial", "bar", "room")
    assert [r[0] for r in rows] == ["d1"] * (2 if hold else 3) + ["d2"] * 3
    assert result.rejected.count() == 1
    assert (read.value, limits, spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == (9, ["8000"], limit)


def test_rows_of_values_are_matched_once(spark):
    from deltaloom.operators.normalize import split_rows

    texts = ["INSERT INTO t (a, b) VALUES (1, 'x, (y)'), (?, 'it''s'), (3, NULL) ON CONFLICT (a) DO NOTHING", "INSERT INTO t (a) VALUES (1), (f(2))", "DELETE FROM t", "INSERT INTO t (a) VALUES ('\u0001'), ('b')"]
    split = split_rows(log_of(spark, [(t, [5]) for t in texts]))
    found = [(r["sql"].split("VALUES")[-1].strip(), len(r["args"])) for r in split.orderBy("_seq", "_txn_seq").collect()]
    tail = " ON CONFLICT (a) DO NOTHING"
    assert found == [("(1, 'x, (y)')" + tail, 0), ("(?, 'it''s')" + tail, 1), ("(3, NULL)" + tail, 0), ("(1), (f(2))", 1), ("DELETE FROM t", 1), ("('\u0001')", 0), ("('b')", 0)]
    assert split._jdf.queryExecution().optimizedPlan().toString().count("_found") > 0
