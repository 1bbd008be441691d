"""Tables kept as change batches, writers, fan-out, pausing, stateful rows."""

import random

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from deltaloom.model import DELETE, INSERT, ROW_OPS, TRUNCATE, UPDATE, UPSERT
from deltaloom.operators.fold import fold, spread
from deltaloom.operators.normalize import hold_gaps
from deltaloom.plans import replay
from deltaloom.sinks import writers
from deltaloom.sinks.changetable import ChangeTable
from deltaloom.storage import broadcast_checked, broadcast_counted, cut_lineage, shared_dir
from deltaloom.streaming import apply as st
from deltaloom.streaming.current import _advance
from test_fold import LOG, as_dict, random_log, simulate, spec_of


def table_of(spark, tmp_path, *ops, first_segment=None):
    return ChangeTable(spark, str(tmp_path / "t"), spec_of(spark), (*ROW_OPS, *ops), first_segment)


def bytes_below(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


@pytest.mark.parametrize("snapshots", [False, True])
def test_redelivery_in_later_batches_changes_nothing(spark, tmp_path, snapshots):
    log = random_log(21, rows=400)
    table = table_of(spark, tmp_path)
    rnd = random.Random(1)
    for n, end in enumerate((150, 151, 400)):
        start = (0, 150, 151)[n]
        batch = log[start:end] + rnd.sample(log[:start], min(start, 60))
        assert table.apply(spark.createDataFrame(batch, LOG), n)
        if snapshots:
            table.snapshot()
    assert as_dict(table.read()) == simulate(log)
    assert not table.apply(spark.createDataFrame(random_log(22), LOG), 2)
    assert as_dict(table.read()) == simulate(log)


def test_a_scattered_batch_writes_no_more_than_itself(spark, tmp_path):
    """20,000 rows stand in the table; changes of 20 keys all over it write some kilobytes, and no file that was there is touched."""
    table = table_of(spark, tmp_path)
    rows = spark.range(20_000).selectExpr("'d' _device_id", "'n' _device_name", "0L _segment", "id _seq", "0L _txn_seq", "id _commit_id",
                                          f"'{INSERT}' _op", "cast(null as array<string>) _set_cols", "id", "uuid() a", "id b")
    table.apply(rows, 0)
    table.snapshot()
    before, files = bytes_below(tmp_path), {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    table.apply(spark.createDataFrame([("d", "n", 1, i, 0, 9, UPDATE, ["a"], i * 1000, "y", None) for i in range(20)], LOG), 1)
    assert bytes_below(tmp_path) - before < before / 20
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    assert table.read().where("a = 'y'").count() == 20 and table.read().count() == 20_000


def test_truncate_reaches_every_row_of_its_device(spark, tmp_path):
    table = table_of(spark, tmp_path, TRUNCATE)
    rows = [(d, "n", 0, i, 0, i, INSERT, None, i, "x", i) for i in range(40) for d in ("d0", "d1")]
    table.apply(spark.createDataFrame(rows, LOG), 0)
    table.snapshot()
    cut = [("d0", "n", 1, 0, 0, 9, TRUNCATE, None, None, None, None)]
    table.apply(spark.createDataFrame(cut, LOG), 1)
    assert {r["_device_id"] for r in table.read().collect()} == {"d1"} and table.read().count() == 40


def test_an_unfinished_batch_is_invisible_and_written_again(spark, tmp_path):
    table = table_of(spark, tmp_path)
    first, second = (spark.createDataFrame([("d", "n", 0, i, 0, i, INSERT, None, i, "x", i)], LOG) for i in (1, 2))
    table.apply(first, 0)
    table.apply(second, 1)
    done = tmp_path / "t" / "changes" / "batch=000000000001" / "_SUCCESS"
    done.rename(done.with_name("_started"))  # a crash before Spark's commit
    assert table.read().count() == 1 and table.last_batch() == 0
    assert table.apply(second, 1) and table.read().count() == 2
    table.snapshot()
    cut = next((tmp_path / "t" / "snapshots").iterdir()) / "state" / "_SUCCESS"
    cut.rename(cut.with_name("_started"))
    assert table.read().count() == 2 and not table.apply(second, 1)


def test_late_rows_take_their_place(spark, tmp_path):
    """Batches in any order give the table of the log in order, as long as no snapshot has folded later rows."""
    log = random_log(23, rows=300)
    table = table_of(spark, tmp_path)
    for n, part in enumerate((log[200:], log[:100], log[100:200])):
        table.apply(spark.createDataFrame(part, LOG), n)
    assert as_dict(table.read()) == simulate(log)


def test_gaps_hold_back_and_marks_release(spark):
    rows = [("d", "n", s, 1, 0, s, INSERT, None, s, "x", s) for s in (0, 1, 3, 4)]
    rows += [("e", "n", s, 1, 0, s, INSERT, None, s, "x", s) for s in (0, 1)]
    log = spark.createDataFrame(rows, LOG)
    marks = log.where("false").select("_device_id", "_device_name", F.struct("_segment", "_seq", "_txn_seq").alias("_applied"))
    ready, held = hold_gaps(log, marks)
    assert sorted((r["_device_id"], r["_segment"]) for r in held.collect()) == [("d", 3), ("d", 4)]
    assert ready.count() == 4
    later = spark.createDataFrame([("d", "n", s, 1, 0, s, INSERT, None, s, "x", s) for s in (2, 3, 4)], LOG)
    done = spark.createDataFrame([("d", "n", (1, 1, 0))], "_device_id string, _device_name string, _applied struct<_segment:bigint,_seq:bigint,_txn_seq:bigint>")
    assert hold_gaps(later, done)[1].count() == 0


@pytest.mark.parametrize("snapshots", [False, True])
def test_pause_keeps_order_and_marks(spark, tmp_path, snapshots):
    log = random_log(31, rows=200)
    table = table_of(spark, tmp_path)
    table.apply(spark.createDataFrame(log[:50], LOG), 0)
    table.pause(["d0"])
    paused_at = simulate(log[:50])
    for n, part in ((1, log[50:100]), (2, log[100:])):
        table.apply(spark.createDataFrame(part, LOG), n)
        if snapshots:
            table.snapshot()
    assert [r["_device_id"] for r in table_of(spark, tmp_path).paused().collect()] == ["d0"]
    of_d0 = lambda rows: {k: v for k, v in rows.items() if k[0] == "d0"}
    assert of_d0(as_dict(table.read())) == of_d0(paused_at)
    assert table.waiting().select("_device_id").distinct().collect()[0][0] == "d0"
    table.resume(["d0"])
    assert as_dict(table.read()) == simulate(log) and table.waiting().count() == 0


def test_a_missing_segment_holds_a_device_over_snapshots(spark, tmp_path):
    table = table_of(spark, tmp_path, first_segment=0)
    row = lambda s: spark.createDataFrame([("d", "n", s, 1, 0, s, INSERT, None, s, "x", s)], LOG)
    for n, segment in enumerate((0, 2, 3)):
        table.apply(row(segment), n)
        table.snapshot()
    assert {r["id"] for r in table.read().collect()} == {0} and table.waiting().count() == 2
    table.apply(row(1), 3)
    assert {r["id"] for r in table.read().collect()} == {0, 1, 2, 3} and table.waiting().count() == 0


def test_reinitialise_shared_keeps_rows_and_forgets_progress(spark, tmp_path):
    log = random_log(41, rows=200)
    table = table_of(spark, tmp_path)
    table.apply(spark.createDataFrame(log, LOG), 0)
    st.reinitialise(table, "d0", clean=True, shared=True)
    assert as_dict(table.read()) == simulate(log)
    assert [r["_device_id"] for r in table.marks().collect()] == ["d1"]
    seed = spark.createDataFrame([("d0", "n0", 5, 77, "seeded", 1)], table.read().select("_device_id", "_device_name", "_commit_id", "id", "a", "b").schema)
    st.reinitialise(table, "d0", clean=False, shared=True, seed=seed)
    assert {k: v for k, v in as_dict(table.read()).items() if k[0] == "d0"} == {("d0", 77): ("seeded", 1, 5)}


def test_init_modes(spark):
    state = fold(spark.createDataFrame(random_log(51), LOG), spec_of(spark))
    devices = spark.createDataFrame([("d0", "n0")], "_device_id string, _device_name string")
    assert replay.initial_state(state, devices, replay.OVERWRITE_OBJECT, shared=False) is None
    assert {r["_device_id"] for r in replay.initial_state(state, devices, replay.OVERWRITE_OBJECT, shared=True).collect()} == {"d1"}
    assert replay.initial_state(state, devices, replay.APPEND_DATA, shared=True) is state
    assert replay.initial_state(None, devices, replay.TRY_CREATE_APPEND_DATA, shared=True) is None
    with pytest.raises(ValueError):
        replay.initial_state(None, devices, replay.APPEND_DATA, shared=True)


def test_consolidated_tables_can_be_merged_into(spark, sf):
    spec = fx.orders_spec(spark, sf)
    first = replay.consolidate(fx.orders_log(spark, sf, segments=range(2)), spec, fx.ORDERS_OPS)
    then = replay.consolidate(fx.orders_log(spark, sf, segments=range(2, 6)), spec, fx.ORDERS_OPS, replay.state_of(first, spec))
    whole = replay.consolidate(fx.orders_log(spark, sf), spec, fx.ORDERS_OPS)
    assert then.exceptAll(whole).count() == 0 and whole.exceptAll(then).count() == 0


def test_writers(spark, sf, tmp_path):
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    path = str(tmp_path / "n")
    writers.write(nation, writers.Destination("parquet", path, partition_by=("n_regionkey",)), "overwrite")
    writers.write(nation, writers.Destination("parquet", path, partition_by=("n_regionkey",)))
    assert spark.read.parquet(path).count() == 50
    assert writers.device_namespace("NAME_AND_ID", "0a-1b", "shop 1") == "shop_1_0a_1b"
    text = writers.merge_statement(spec_of(spark), "t", "s")
    assert text.startswith("MERGE INTO t t USING s s ON t.id = s.id WHEN MATCHED AND s._op = 'DELETE' THEN DELETE")
    assert text.endswith("INSERT (id, a, b) VALUES (s.id, s.a, s.b)")


def test_observed_counts(spark, tmp_path):
    rows = [("d", "n", 0, i, 0, i, INSERT if i % 2 else UPDATE, None, i, "x", i) for i in range(10)]
    spark.createDataFrame(rows, LOG).write.parquet(str(tmp_path / "in" / "a"))
    stream = st.observed(st.read_change_files(spark, str(tmp_path / "in"), spark.createDataFrame([], LOG).schema), "ops")
    query = st.start_append(stream, str(tmp_path / "out"), str(tmp_path / "c"))
    query.awaitTermination()
    seen = [p["observedMetrics"]["ops"] for p in query.recentProgress if p["numInputRows"]]
    assert (seen[0]["changes"], seen[0]["insert"], seen[0]["update"]) == (10, 5, 5)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_state_of_one_key_equals_the_simulation(seed):
    log = [r for r in random_log(seed, keys=3, devices=1) if r[8] == 0]
    names = ["_device_id", "_device_name", "_segment", "_seq", "_txn_seq", "_commit_id", "_op", "_set_cols", "id", "a", "b"]
    state = (False, -2, 0, 0, 0, None, None)
    for start in range(0, len(log), 7):
        # every batch delivers a few earlier rows again
        batch = log[max(0, start - 3) : start + 7]
        state = _advance(state, (dict(zip(names, r)) for r in batch), ["a", "b"])
    want = simulate(log).get(("d0", 0))
    assert (state[0], state[5:]) == (want is not None, (want[0], want[1]) if want else (None, None))


def test_broadcast_only_within_the_bound(spark):
    small = spark.range(10)
    assert "hint" in broadcast_checked(small, 10)._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in broadcast_checked(small, 9)._jdf.queryExecution().logical().toString().lower()
    assert broadcast_counted(small, 11, 10) is small


def test_cut_lineage_goes_to_the_shared_folder(spark):
    cut = cut_lineage(spark.range(5).withColumn("v", F.lit("x")))
    assert all(shared_dir(spark).replace("file:", "") in f for f in cut.inputFiles())
    assert "Range" not in cut._jdf.queryExecution().executedPlan().toString() and cut.count() == 5




def test_current_rows_keep_wide_integers(spark, tmp_path):
    from deltaloom.streaming import current

    big = 2**53 + 1
    rows = [("d", "n", 0, 1, 0, 1, INSERT, None, 1, "x", None), ("d", "n", 0, 2, 0, 2, INSERT, None, 2, "y", big), ("d", "n", 1, 1, 0, 3, INSERT, None, 1, "z", None)]
    frame = spark.createDataFrame(rows, LOG)
    frame.write.parquet(str(tmp_path / "in" / "x"))
    stream = st.read_change_files(spark, str(tmp_path / "in"), frame.schema)
    out = current.current_rows(stream, spec_of(spark)).writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(str(tmp_path / f"out-{n}")))
    out.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out-0"))
    assert dict(got.dtypes)["b"] == "bigint" and {r["id"]: r["b"] for r in got.collect()} == {1: None, 2: big}


def test_current_rows_without_upserts_are_an_aggregation(spark, tmp_path):
    from deltaloom.streaming import current

    ops = (INSERT, UPDATE, DELETE)
    log = [r for r in random_log(5, keys=6, devices=2) if r[6] in ops]
    log.append((None, None, 0, 1, 0, 1, INSERT, None, 7, None, None))
    batches = [log[: len(log) // 2], log[len(log) // 2 - 5 :], log[-5:]]
    schema, emitted = spark.createDataFrame([], LOG).schema, []
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, LOG).write.parquet(str(tmp_path / "in" / str(number)))
        found = current.current_rows(st.read_change_files(spark, str(tmp_path / "in"), schema), spec_of(spark), ops)
        assert "Python" not in found._jdf.queryExecution().analyzed().toString()
        query = found.writeStream.foreachBatch(lambda df, n: emitted.append(df.collect())).outputMode("update")
        query.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    state = {}
    for batch in emitted:
        state |= {(r["_device_id"], r["id"]): (r["a"], r["b"], r["_commit_id"]) if r["_live"] else None for r in batch}
    assert {k: v for k, v in state.items() if v} == simulate(log)
    assert len(emitted) == 2 or not emitted[2], "rows delivered again are not emitted again"


def test_log_files_are_dealt_out_by_key_before_they_are_folded(spark, tmp_path):
    """One well compressed file is one split; the sort of the fold must not see all its rows in one task, nor all rows of a hot key."""
    table = table_of(spark, tmp_path)
    log = spark.range(4000).selectExpr("'d' _device_id", "'n' _device_name", "id div 100 _segment", "id _seq", "0L _txn_seq", "id _commit_id",
                                       f"'{UPSERT}' _op", "cast(null as array<string>) _set_cols", "if(id % 2 = 0, 0, id) id", "'x' a", "id b")
    table.apply(log.coalesce(1), 0)
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    shared = spread(spark.read.parquet(str(tmp_path / "t" / "changes")), spec_of(spark)).withColumn("p", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert shared.where("id = 0").select("p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert table.read().count() == 2001 and table.read().where("id = 0").first()["b"] == 3998
