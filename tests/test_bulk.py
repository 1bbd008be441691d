"""Bulk changes against a sequential simulation on random logs."""

import random

import pytest

from deltaloom.model import DELETE, INSERT, ROW_OPS, UPDATE
from deltaloom.operators.barriers import BULK_COLS, TERM_TYPE, fold_with_bulk
from test_fold import LOG, as_dict, random_log, simulate, spec_of

BULK = (
    "_device_id string, _device_name string, _segment bigint, _seq bigint, _txn_seq bigint, _commit_id bigint, _op string,"
    f" _terms {TERM_TYPE}, _predicate string, _set map<string,binary>"
)


def raw(value):
    return None if value is None else bytearray(str(value).encode())


def random_bulk(rnd, n, dev):
    kind = rnd.choice(["eq_update", "eq_delete", "range_delete", "text_update"])
    head = (f"d{dev}", f"n{dev}", n // 100, n, 0, 1000 + n)
    if kind == "eq_update":
        a, b = rnd.choice(["x", "y"]), rnd.randrange(5)
        return (*head, "UPDATE_WHERE", [("a", "=", raw(a))], None, {"b": raw(b)}), ("set", lambda r: r["a"] == a, {"b": b})
    if kind == "eq_delete":
        a = rnd.choice(["x", "y"])
        return (*head, "DELETE_WHERE", [("a", "=", raw(a))], None, None), ("del", lambda r: r["a"] == a, None)
    if kind == "range_delete":
        low = rnd.randrange(900)
        return (
            (*head, "DELETE_WHERE", [("b", ">", raw(low)), ("a", "<>", raw("x"))], None, None),
            ("del", lambda r: r["b"] is not None and r["b"] > low and r["a"] is not None and r["a"] != "x", None),
        )
    return (
        (*head, "UPDATE_WHERE", None, "a IS NULL OR a = 'y'", {"a": raw("t")}),
        ("set", lambda r: r["a"] is None or r["a"] == "y", {"a": "t"}),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_bulk_changes_act_at_their_position(spark, seed):
    rnd = random.Random(seed)
    log = random_log(seed, keys=20, rows=300)
    places = sorted(rnd.sample(range(300), 5)) + [299]
    first = places[0]
    places = sorted(set(places) | {first + 1})
    bulk, effects = [], {}
    for n in places:
        dev = rnd.randrange(2)
        row, effect = random_bulk(rnd, n, dev)
        bulk.append(row)
        effects[n] = (f"d{dev}", *effect)
    keyed = [r for r in log if r[3] not in effects]
    state = {}
    for n in range(300):
        if n in effects:
            dev, what, hit, values = effects[n]
            for at in [k for k in state if k[0] == dev]:
                row = {"a": state[at][0], "b": state[at][1]}
                if hit(row):
                    if what == "del":
                        del state[at]
                    else:
                        row.update(values)
                        state[at] = (row["a"], row["b"], 1000 + n)
        else:
            one = [r for r in keyed if r[3] == n]
            state = simulate(one, {k: ({"a": v[0], "b": v[1]}, v[2]) for k, v in state.items()})
    got = fold_with_bulk(
        spark.createDataFrame(keyed, LOG), spark.createDataFrame(bulk + bulk[:2], BULK), spec_of(spark), ROW_OPS, cut_every=2
    )
    assert as_dict(got) == state


def test_a_run_of_parameter_rows_is_one_round(spark):
    log = [("d0", "n0", 0, i, 0, i, INSERT, None, i, f"k{i}", 0) for i in range(50)]
    bulk = [
        ("d0", "n0", 1, i, 0, 100 + i, "UPDATE_WHERE", [("a", "=", raw(f"k{i % 50}"))], None, {"b": raw(i)}) for i in range(100)
    ]
    from deltaloom.operators.barriers import _shaped, run_starts

    frame = spark.createDataFrame(bulk, BULK)
    assert [len(r["_runs"]) for r in run_starts(_shaped(frame)).collect()] == [1]
    got = as_dict(fold_with_bulk(spark.createDataFrame(log, LOG), frame, spec_of(spark), (INSERT, UPDATE, DELETE)))
    assert {k[1]: v[1] for k, v in got.items()} == {i: i + 50 for i in range(50)}


def test_overlapping_assignments_are_applied_in_turn(spark):
    log = [("d0", "n0", 0, 1, 0, 1, INSERT, None, 1, "p", 0)]
    steps = [("p", "q"), ("q", "r"), ("p", "wrong")]
    bulk = [
        ("d0", "n0", 1, i, 0, 100 + i, "UPDATE_WHERE", [("a", "=", raw(old))], None, {"a": raw(new)})
        for i, (old, new) in enumerate(steps)
    ]
    got = as_dict(fold_with_bulk(spark.createDataFrame(log, LOG), spark.createDataFrame(bulk, BULK), spec_of(spark), (INSERT,)))
    assert got == {("d0", 1): ("r", 0, 101)}
    assert list(BULK_COLS)[-1] == "_set"
