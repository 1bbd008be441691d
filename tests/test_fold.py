"""The fold against a sequential simulation on random logs."""

import random

import pytest
from pyspark.sql import functions as F

from deltaloom.model import DELETE, INSERT, REPLACE, ROW_OPS, TRUNCATE, UPDATE, UPSERT, TableSpec
from deltaloom.operators.fold import change_counts, compact, fold, last_images, merge

LOG = (
    "_device_id string, _device_name string, _segment bigint, _seq bigint, _txn_seq bigint, _commit_id bigint,"
    " _op string, _set_cols array<string>, id bigint, a string, b bigint"
)


def spec_of(spark):
    return TableSpec("t", spark.createDataFrame([], "id bigint, a string, b bigint").schema, ("id",))


def random_log(seed, keys=60, rows=900, devices=2, start=0):
    rnd = random.Random(seed)
    log = []
    for n in range(start, start + rows):
        # a third of all rows belongs to key 0
        key = 0 if rnd.random() < 0.33 else rnd.randrange(keys)
        dev = rnd.randrange(devices)
        op = rnd.choices(ROW_OPS, [3, 5, 3, 3, 1])[0]
        cols = rnd.choice([["a"], ["b"], ["a", "b"], []]) if op in (UPDATE, UPSERT) else rnd.choice([None, ["id", "a"], ["id", "a", "b"]])
        a = rnd.choice([None, "x", "y", f"v{n}"])
        b = rnd.choice([None, n])
        if cols is not None:
            a, b = a if "a" in cols else None, b if "b" in cols else None
        if op == DELETE:
            a = b = cols = None
        log.append((f"d{dev}", f"n{dev}", n // 100, n, 0, 1000 + n, op, cols, key, a, b))
    return log


def simulate(log, state=None):
    state = dict(state or {})
    for dev, _, _, _, _, commit, op, cols, key, a, b in sorted(log, key=lambda r: (r[2], r[3], r[4])):
        if op == TRUNCATE:
            state = {k: v for k, v in state.items() if k[0] != dev}
            continue
        at = (dev, key)
        new = {"a": a, "b": b}
        named = ["a", "b"] if cols is None else [c for c in cols if c in new]
        if op in (INSERT, REPLACE):
            state[at] = ({c: new[c] if c in named else None for c in new}, commit)
        elif op == DELETE:
            state.pop(at, None)
        elif op == UPSERT or at in state:
            row = dict(state[at][0]) if at in state else {"a": None, "b": None}
            row.update({c: new[c] for c in named})
            state[at] = (row, commit)
    return {k: (v[0]["a"], v[0]["b"], v[1]) for k, v in state.items()}


def as_dict(df):
    return {(r["_device_id"], r["id"]): (r["a"], r["b"], r["_commit_id"]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_equals_simulation(spark, seed):
    log = random_log(seed)
    again = log + random.Random(seed).sample(log, 200)
    assert as_dict(fold(spark.createDataFrame(again, LOG), spec_of(spark))) == simulate(log)


def test_truncate_is_scoped_to_its_device(spark):
    log = random_log(5)
    log.insert(450, ("d1", "n1", 4, 449, 5, 1449, TRUNCATE, None, None, None, None))
    got = as_dict(fold(spark.createDataFrame(log, LOG), spec_of(spark), (*ROW_OPS, TRUNCATE)))
    assert got == simulate(log)


def test_any_split_into_batches_gives_the_same_state(spark):
    log = random_log(7)
    spec = spec_of(spark)
    state = fold(spark.createDataFrame(log[:300], LOG), spec)
    for part in (log[300:310], log[310:700], log[700:]):
        state = merge(state, spark.createDataFrame(part, LOG), spec)
    assert as_dict(state) == simulate(log)


def test_merge_truncates_the_state_too(spark):
    log = random_log(8)
    spec = spec_of(spark)
    cut = [("d0", "n0", 6, 600, 5, 1600, TRUNCATE, None, None, None, None)]
    ops = (*ROW_OPS, TRUNCATE)
    state = merge(
        fold(spark.createDataFrame(log[:500], LOG), spec), spark.createDataFrame(log[500:] + cut, LOG), spec, ops
    )
    assert as_dict(state) == simulate(log + cut)


def test_compacted_log_is_equivalent_with_and_without_a_base(spark):
    log, base = random_log(11, start=500), random_log(12, rows=200)
    spec = spec_of(spark)
    short = compact(spark.createDataFrame(log, LOG), spec)
    assert short.groupBy("_device_id", "id").count().agg(F.max("count")).first()[0] <= 2
    assert {k: v[:2] for k, v in as_dict(fold(short, spec)).items()} == {
        k: v[:2] for k, v in simulate(log).items()
    }
    state = fold(spark.createDataFrame(base, LOG), spec)
    got = as_dict(merge(state, short, spec))
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in simulate(log, _rows(simulate(base))).items()}


def test_compacted_updates_name_only_what_was_written(spark):
    log = [("d", "n", 0, 1, 0, 1, UPDATE, ["a"], 1, "x", None), ("d", "n", 0, 2, 0, 2, UPDATE, ["a"], 1, None, None)]
    rows = compact(spark.createDataFrame(log, LOG), spec_of(spark)).collect()
    assert [(r["_op"], r["_set_cols"], r["a"]) for r in rows] == [(UPDATE, ["a"], None)]


def _rows(state):
    return {k: ({"a": v[0], "b": v[1]}, v[2]) for k, v in state.items()}


def test_declared_ops_are_enforced(spark):
    df = spark.createDataFrame([("d", "n", 0, 0, 0, 1, UPSERT, ["a"], 1, "x", None)], LOG)
    with pytest.raises(Exception, match="outside the declared set"):
        fold(df, spec_of(spark), (INSERT, UPDATE, DELETE)).collect()


def test_change_counts(spark):
    spec = spec_of(spark)

    def rows(*items):
        return spark.createDataFrame([("d", "n", s, q, 0, 1, op, cols, k, a, None) for s, q, op, cols, k, a in items], LOG)

    state = fold(rows((0, 1, INSERT, None, 1, "x"), (0, 2, INSERT, None, 2, "x"), (0, 3, INSERT, None, 3, "x")), spec)
    batch = rows((1, 1, UPDATE, ["a"], 1, "y"), (1, 2, DELETE, None, 2, None), (1, 3, INSERT, None, 9, "z"), (1, 4, DELETE, None, 8, None))
    assert change_counts(merge(state, batch, spec, report=True)).first().asDict() == {
        "inserted": 1,
        "updated": 1,
        "deleted": 1,
    }


def test_last_images_keep_the_final_row(spark):
    log = [("d", "n", 0, i, 0, i, INSERT, None, 1, str(i), i) for i in range(5)]
    row = last_images(spark.createDataFrame(log, LOG), spec_of(spark)).collect()
    assert len(row) == 1 and row[0]["a"] == "4" and row[0]["_seq"] == 4


def test_the_fold_is_one_shuffle_without_windows(spark):
    plan = fold(spark.createDataFrame(random_log(1), LOG), spec_of(spark), (INSERT, UPDATE, DELETE))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text
