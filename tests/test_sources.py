"""Segment files, JDBC options, messages, incremental reads."""

import random
import re
import sqlite3

import pytest
from pyspark.sql import functions as F

from deltaloom.operators.normalize import LOG_COLS, expand_transaction_stream, expand_transactions
from deltaloom.sources import files, jdbc, messages
from deltaloom.sources import segments as sg
from deltaloom.streaming.apply import start_append

PATTERN = r"/(?P<name>[a-z]+)_(?P<id>[a-z0-9]+)/"


def segment(folder, name, rows, slots=3, table="commandlog"):
    folder.mkdir(parents=True, exist_ok=True)
    conn = sqlite3.connect(folder / name)
    args = "".join(f", arg{i} BLOB" for i in range(1, slots + 1))
    conn.execute(f"CREATE TABLE {table} (change_sequence_number INTEGER PRIMARY KEY, commit_id INTEGER, sql TEXT, argcnt INTEGER{args})")
    for seq, commit, text, values in rows:
        padded = (list(values) + [None] * slots)[:slots]
        conn.execute(f"INSERT INTO {table} VALUES ({', '.join('?' * (4 + slots))})", [seq, commit, text, len(values), *padded])
    conn.commit()
    conn.close()


def metadata(folder, name, **entries):
    conn = sqlite3.connect(folder / name)
    conn.execute("CREATE TABLE metadata (key TEXT, value TEXT)")
    conn.executemany("INSERT INTO metadata VALUES (?, ?)", [(k.replace("_", "-"), v) for k, v in entries.items()])
    conn.commit()
    conn.close()


def test_values_keep_their_bytes(spark, tmp_path):
    segment(tmp_path / "one_d1", "0.sqllog", [(1, 5, "X", [1, 2.5, "é"]), (2, 5, "", [b"\x00\xff", None]), (3, 6, "Y", [])])
    rows = sg.scan_log(spark, str(tmp_path), PATTERN).orderBy("_seq").collect()
    assert [r["sql"] for r in rows] == ["X", "X", "Y"]
    assert [bytes(a) for a in rows[0]["args"]] == [b"1", b"2.5", "é".encode()]
    assert [None if a is None else bytes(a) for a in rows[1]["args"]] == [b"\x00\xff", None]
    assert (rows[0]["_device_id"], rows[0]["_device_name"], rows[0]["_segment"], rows[0]["_commit_id"]) == ("d1", "one", 0, 5)


def test_more_arguments_than_stored_columns(spark, tmp_path):
    segment(tmp_path / "one_d1", "0.sqllog", [(1, 5, "X", list(range(20)))], slots=18)
    args = sg.scan_log(spark, str(tmp_path), PATTERN).first()["args"]
    assert len(args) == 20 and bytes(args[17]) == b"17" and args[18:] == [None, None]


def test_a_large_file_is_read_in_ranges_and_still_filled(spark, tmp_path):
    rows = [(i, 1, f"S{i}" if i % 10 == 1 else "", [i]) for i in range(1, 1001)]
    segment(tmp_path / "one_d1", "0.sqllog", rows)
    log = sg.scan_log(spark, str(tmp_path), PATTERN, split_bytes=4096)
    assert log.rdd.getNumPartitions() > 3
    found = {r["_seq"]: r["sql"] for r in log.collect()}
    assert found == {i: f"S{(i - 1) // 10 * 10 + 1}" for i in range(1, 1001)}
    raw = sg.scan_log(spark, str(tmp_path), PATTERN, fill=False)
    assert raw.where("sql = ''").count() == 900


def test_metadata_decides_what_is_ready(spark, tmp_path):
    folder = tmp_path / "one_d1"
    for n, status in enumerate(["APPLIED", "READY_TO_APPLY"]):
        segment(folder, f"{n}.sqllog", [(1, 1, f"S{n}", [])])
        metadata(folder, f"{n}.metadata", uuid="u", device_name="one", status=status)
    segment(folder, "2.sqllog", [(1, 1, "S2", [])])
    meta = sg.segment_metadata(sg.scan_metadata(spark, str(tmp_path), PATTERN))
    assert {r["_segment"]: r["status"] for r in meta.collect()} == {0: "APPLIED", 1: "READY_TO_APPLY"}
    ready = sg.ready_segments(sg.scan_log(spark, str(tmp_path), PATTERN), meta)
    assert {r["sql"] for r in ready.collect()} == {"S1", "S2"}


def test_default_device_folder_names(spark, tmp_path):
    segment(tmp_path / "store_branch1_0a-1b", "3.sqllog", [(1, 1, "S", [])])
    segment(tmp_path / "store-branch2-0c-1d", "4.sqllog", [(1, 1, "S", [])])
    rows = sg.scan_log(spark, str(tmp_path)).orderBy("_segment").collect()
    assert [(r["_device_name"], r["_device_id"]) for r in rows] == [("branch1", "0a-1b"), ("branch2", "0c-1d")]


def test_stream_offsets_hold_a_device_at_a_gap(spark, tmp_path):
    stage, out = tmp_path / "stage", str(tmp_path / "out")
    for n in (0, 1, 3):
        segment(stage / "one_d1", f"{n}.sqllog", [(1, 1, f"d1-{n}", [])])
    segment(stage / "two_d2", "0.sqllog", [(1, 1, "d2-0", [])])

    def drain():
        log = sg.scan_log(spark, str(stage), PATTERN, streaming=True)
        query = log.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-c")
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(r["sql"] for r in spark.read.parquet(out).collect())

    assert drain() == ["d1-0", "d1-1", "d2-0"]
    segment(stage / "one_d1", "2.sqllog", [(1, 1, "d1-2", [])])
    assert drain() == ["d1-0", "d1-1", "d1-2", "d1-3", "d2-0"]


def test_small_files_share_tasks(spark, tmp_path):
    for n in range(200):
        segment(tmp_path / "one_d1", f"{n}.sqllog", [(1, n, f"S{n}", [])])
    log = sg.scan_log(spark, str(tmp_path), PATTERN)
    assert 32 <= log.rdd.getNumPartitions() <= 100
    assert sorted(r["_segment"] for r in log.collect()) == list(range(200))


def test_empty_stage(spark, tmp_path):
    assert sg.scan_log(spark, str(tmp_path), PATTERN).count() == 0


class Recorder:
    """Stands in for a Spark reader or writer and keeps the options it was given."""

    def __init__(self, bounds=(1, 100)):
        self.calls, self.options_seen, self.bounds = [], {}, bounds

    def format(self, name):
        self.calls.append(name)
        return self

    def option(self, name, value):
        new = Recorder(self.bounds)
        new.calls, new.options_seen = self.calls, {**self.options_seen, name: value}
        return new

    def load(self):
        self.calls.append(self.options_seen)
        return self

    def first(self):
        return self.bounds


class FakeSpark:
    def __init__(self, reader):
        self.read = reader


def test_jdbc_reads_are_split_between_the_bounds_of_the_table():
    reader = Recorder()
    source = jdbc.JdbcTable("jdbc:x", "orders", {"driver": "d"})
    got = jdbc.read_table(FakeSpark(reader), source, "id", 16, watermark="ts", last="2024-01-01").options_seen
    assert reader.calls[1]["dbtable"] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM orders) bounds"
    assert got["dbtable"] == "(SELECT * FROM orders WHERE ts > '2024-01-01') changed"
    assert (got["lowerBound"], got["upperBound"], got["numPartitions"], got["driver"]) == ("1", "100", "16", "d")


def test_jdbc_reads_of_an_empty_table_are_not_split():
    got = jdbc.read_table(FakeSpark(Recorder((None, None))), jdbc.JdbcTable("jdbc:x", "t"), "id").options_seen
    assert "numPartitions" not in got and got["dbtable"] == "t"


def test_watermark_reaches_the_scan(spark, sf):
    orders = files.read_after(files.read_parquet(spark, f"{sf}/orders.parquet"), "o_orderkey", 100)
    plan = orders.select("o_totalprice")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,100)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert files.new_mark(orders, "o_orderkey") == files.read_parquet(spark, f"{sf}/orders.parquet").count() - 1


def test_payload_side_output(spark):
    df = spark.createDataFrame([("a", "1;2.5"), ("b", "x;2.5"), ("c", "1"), ("d", None), ("e", "1;2;3")], "t string, payload string")
    parsed = messages.parse_payload(df, "id bigint, v double", ";")
    assert [tuple(r) for r in messages.accepted(parsed, "t").collect()] == [("a", 1, 2.5)]
    assert sorted(r["t"] for r in messages.rejected(parsed).collect()) == ["b", "c", "d", "e"]


@pytest.mark.parametrize(
    "pattern,topic,hit",
    [
        ("a/+/c", "a/b/c", True), ("a/+/c", "a/b/d/c", False), ("a/#", "a/b/c", True), ("a.b/#", "axb/c", False), ("#", "x/y", True),
        ("a/#", "a", True), ("a/#", "ab", False), ("a/+/#", "a", False), ("a/+", "a/", True), ("a//b", "a//b", True), ("#", "$sys/x", False),
        ("+/x", "$sys/x", False), ("$sys/#", "$sys/x", True), ("+", "a", True), ("+", "a/b", False),
    ],
)
def test_topic_patterns(spark, pattern, topic, hit):
    df = spark.createDataFrame([(topic,)], "topic string")
    got = messages.map_topics(df, [messages.TopicRule(pattern, "t")]).first()["_table"]
    assert (got == "t") is hit


def test_topics_by_a_table_of_rules(spark):
    """Random rules and topics: the table of rules gives what the patterns one by one give."""
    rnd = random.Random(3)
    levels = ["a", "b", "", "c.d", "$s"]
    topics = sorted({"/".join(rnd.choice(levels) for _ in range(rnd.randrange(1, 5))) for _ in range(300)})
    patterns = []
    while len(patterns) < 150:
        parts = [rnd.choice([*levels, "+"]) for _ in range(rnd.randrange(0, 5))] + ["#"] * rnd.randrange(2)
        if parts:
            patterns.append("/".join(parts))
    rules = [messages.TopicRule(p, f"t{i % 7}") for i, p in enumerate(patterns)]
    rnd.shuffle(rules)
    expected = {t: next(((r.table, n) for n, r in enumerate(rules) if re.match(r.regex(), t)), (None, None)) for t in topics}
    frame = spark.createDataFrame([(t, i, "x") for i, t in enumerate([*topics, *topics[:9], None])], "topic string, rule int, target string")
    table = spark.createDataFrame([(n, r.pattern, r.table) for n, r in enumerate(rules)], "rule bigint, pattern string, target string")
    found = messages.route_topics(frame, table).collect()
    assert len(found) == len(topics) + 10 and {r["topic"]: (r["_table"], r["_rule"]) for r in found} == expected | {None: (None, None)}
    none = messages.route_topics(frame, table.limit(0)).collect()
    assert len(none) == len(found) and {r["_table"] for r in none} == {None}


def test_feed_needs_an_order(spark):
    from deltaloom.model import TableSpec

    df = spark.createDataFrame([(1, "a")], "id bigint, a string")
    with pytest.raises(ValueError, match="_seq"):
        files.read_feed(df, {}, TableSpec("t", df.schema, ("id",)))


def test_device_from_path(spark):
    df = spark.createDataFrame([("/stage/store_b1_77-aa/0.sqllog",)], "_file string")
    assert tuple(df.select(*sg.device_of()).first()) == ("77-aa", "b1")
    assert df.where(F.col("_file").isNull()).count() == 0


def test_transactions_stream_in_any_order(spark, tmp_path):
    """Control rows before their files, files before their control rows, both over restarts; in the end all rows of a batch replay."""
    stage, out = tmp_path / "stage", str(tmp_path / "out")

    def publish(segment_number, commit, n):
        segment(stage / "one_d1", f"{segment_number}.sqllog.{commit}.txn", [(i, 0, f"T{commit}", [i]) for i in range(n)])

    def run():
        log = sg.scan_log(spark, str(stage), PATTERN, streaming=True)
        rows = expand_transaction_stream(log, sg.scan_transactions(spark, str(stage), PATTERN, streaming=True))
        query = start_append(rows, out, f"{out}-checkpoint")
        query.awaitTermination()
        assert query.exception() is None
        return spark.read.schema(rows.schema).parquet(out)

    segment(stage / "one_d1", "0.sqllog", [(0, 1, "CREATE", []), (1, 2, "REPLAY_TXN(10)", []), (2, 3, "REPLAY_TXN(11)", [])])
    segment(stage / "two_d2", "0.sqllog", [(0, 1, "S", [])])
    publish(0, 11, 2)
    assert sorted(r["sql"] for r in run().collect()) == ["CREATE", "S", "T11", "T11"]
    publish(1, 12, 1)  # its segment is not there yet
    publish(0, 10, 3)  # comes after a later one
    assert run().where("sql = 'T10'").count() == 3 and run().where("sql = 'T12'").count() == 0
    segment(stage / "one_d1", "1.sqllog", [(0, 5, "REPLAY_TXN(12)", []), (1, 6, "S1", [])])
    streamed = run()
    batch, held = expand_transactions(sg.scan_log(spark, str(stage), PATTERN), sg.scan_transactions(spark, str(stage), PATTERN))
    plain = lambda df: sorted(map(str, df.select(*LOG_COLS).collect()))
    assert held.isEmpty() and plain(streamed) == plain(batch) and streamed.count() == 9
