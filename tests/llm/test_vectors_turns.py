"""Hard negatives, near-duplicate vectors and conversation repair against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from deltaloom.llm import embed_dedup, hard_negatives, turn_repair
from deltaloom.llm.hard_negatives import Packed
from deltaloom.llm.vectors import matrix

# vectors


def test_lists_become_rows():
    lists = pa.array([[1.0, 2.0], [], [3.0, 4.0, 5.0]], pa.list_(pa.float32()))
    assert matrix(lists, 3, np.float64).tolist() == [[1, 2, 0], [0, 0, 0], [3, 4, 5]]
    assert matrix(lists.slice(2, 1), 3, np.int64).tolist() == [[3, 4, 5]]


@pytest.mark.parametrize("largest,dims", [(1, 3), (150, 64), (5000, 40), (1 << 20, 200)])
def test_packed_scores_are_exact(largest, dims):
    rng = np.random.default_rng(largest)
    for count in (1, 2, 7, 500):
        q, a = rng.integers(-largest, largest + 1, (count, dims)), rng.integers(-largest, largest + 1, (5, dims))
        a[0], q[0] = largest, -largest
        packed = Packed.of(q, int(np.abs(a).sum(axis=1).max()))
        assert (packed.scores(a, count) == a @ q.T).all()
    assert packed.fields >= {1: 9, 150: 2, 5000: 1, 1 << 20: 1}[largest]


def mined(rows, anchors, positives=5, negatives=3):
    """Rows (anchor, positive, rank, negative, scores), for distinct ids."""
    dims = max(len(v) for _, _, v in rows)
    q = {i: (label, [math.floor(256 * x) for x in v] + [0] * (dims - len(v))) for i, label, v in rows}
    out = set()
    for a in anchors:
        if a not in q:
            continue
        score = {i: sum(x * y for x, y in zip(q[a][1], v, strict=True)) for i, (_, v) in q.items() if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if q[i][0] == q[a][0]][:positives]:
            fits = [i for i in ranked if q[i][0] != q[a][0] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out |= {(a, p, r, i, score[p], score[i]) for r, i in enumerate(fits[:negatives], 1)}
    return out


def awkward_vectors(seed, n=300, dims=6):
    """Distinct ids; negative and tied scores, a label of its own, short, empty, null and unsound vectors."""
    rng = random.Random(seed)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, -5]), [rng.choice([-0.5, 0.0, 0.25, 0.7, 1.0]) for _ in range(dims)]) for i in range(n)]
    rows[7] = (7, 99, [0.1] * dims)
    rows[8], rows[9] = (8, 0, [0.5, 0.25]), (9, 1, [])
    sound = [r for r in rows if r[0] not in (50, 51, 52, 53, 54, 55)]
    odd = [(50, None, [0.1] * dims), (51, 0, None), (52, 0, [0.1, None]), (53, 0, [float("nan")] * dims), (54, 1, [float("inf")]), (None, 0, [0.9] * dims)]
    return sound, odd


def test_hard_negatives_against_all_pairs(spark, monkeypatch):
    sound, odd = awkward_vectors(3)
    rows = [(i, y, v, "x", 1.5, 9) for i, y, v in [*sound, *odd, *sound[:20]]]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, id string, q double, slot int").repartition(7)
    asked = spark.createDataFrame([(i,) for i in [*range(0, 300, 10), 7, 9, 10, 51, 5000, None]], "anchor_id long")
    expected = mined(sound, [*range(0, 300, 10), 7, 9])
    assert {tuple(r) for r in hard_negatives.mine(frame, asked).collect()} == expected and len(expected) > 50
    monkeypatch.setattr(hard_negatives, "ROUND", 1000)  # several rounds
    found = hard_negatives.mine(frame, asked).collect()
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    asked = spark.createDataFrame([(1,)], "anchor_id long")
    assert hard_negatives.mine(none, asked).collect() == []
    one = spark.createDataFrame([(1, 1, [0.5])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(one, asked).collect() == []


def linked(rows, threshold=0.9):
    """(links, component) of each id, for distinct ids."""
    dims = max(len(v) for _, v in rows)
    ids = [i for i, v in rows]
    u = np.array([list(v) + [0.0] * (dims - len(v)) for _, v in rows])
    u = u / np.abs(u).max(axis=1, keepdims=True)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    low = np.array(ids)
    while True:
        new = np.minimum(low, np.where(near, low[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == low).all():
            return {i: (int(near[k].sum()), int(low[k])) for k, i in enumerate(ids)}
        low = new


def crowds(seed=4, dims=16):
    """Tight and wide crowds, chains, pairs, copies, scaled copies and lone vectors, ids in no order."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    parts = [unit(rng.standard_normal((700, dims)))]
    for size, noise in ((400, 0.02), (300, 0.085), (150, 0.12), (60, 0.05)):
        parts.append(unit(unit(rng.standard_normal(dims)) + noise * rng.standard_normal((size, dims))))
    a, b = unit(rng.standard_normal((2, dims)))
    angles = np.linspace(0, 1.5, 40)[:, None]
    parts.append(np.cos(angles) * a + np.sin(angles) * unit(b - (a @ b) * a))
    pairs = unit(rng.standard_normal((50, dims)))
    parts += [pairs, unit(pairs + 0.04 * rng.standard_normal(pairs.shape))]
    v = np.concatenate(parts)
    v = np.concatenate([v, v[:30], v[700:720], v[30:40] * 1024, np.tile(v[41], (50, 1))])
    ids = rng.permutation(len(v) * 3)[: len(v)]
    return [(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)]


def test_near_vectors_against_all_pairs(spark):
    rows = crowds()
    top = max(i for i, _ in rows)
    odd = [(top + 1, None), (top + 2, [0.0] * 16), (top + 3, [1.0, None]), (top + 4, [float("nan")]), (top + 5, []), (top + 6, [float("-inf")]), (None, rows[0][1])]
    lone = {top + k: (0, top + k) for k in range(1, 7)}
    frame = spark.createDataFrame([(i, v, 1, "y", 2) for i, v in [*rows, *odd, *rows[:25]]], "vec_id long, embedding array<double>, id long, key string, c long")
    found = embed_dedup.link(frame.repartition(5)).collect()
    assert len(found) == len(rows) + len(odd) + 25
    expected = linked(rows) | lone
    wrong = {r.vec_id for r in found if r.vec_id is not None and (r.n_links, r.component_id) != expected[r.vec_id]}
    assert wrong == set()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)
    assert [(r.n_links, r.component_id, r.kept) for r in found if r.vec_id is None] == [(0, None, True)]


def test_crowds_that_face_each_other(spark):
    """Two tight crowds whose nearest members just link: every list is full of its own crowd."""
    rng = np.random.default_rng(1)
    a, b = np.zeros(24), np.zeros(24)
    a[0], b[0], b[1] = 1, math.cos(0.42), math.sin(0.42)
    v = np.concatenate([x + 0.004 * rng.standard_normal((120, 24)) for x in (a, b)])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    expected = linked(rows)
    assert {c for _, c in expected.values()} == {0}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.link(frame, k=5).collect()} == expected


def test_near_vectors_of_nothing(spark):
    for rows in ([], [(3, None)], [(3, [0.0])], [(3, [2.0])]):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert [tuple(r) for r in embed_dedup.link(frame).collect()] == [(i, 0, i, True) for i, _ in rows]


def test_large_and_tiny_components(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 1e-300]), (2, [1e300, -1e300]), (3, [3.0, 3.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in embed_dedup.link(frame).collect()) == [(0, 2, 0, True), (1, 2, 0, False), (2, 0, 2, True), (3, 2, 0, False)]


# conversations

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def faults(turns):
    """First fault of each (role, text)."""
    seen, out = set(), []
    for turn in turns:
        body = turn[1].strip(" \t\n\v\f\r")
        out.append("blank" if not body else "duplicate" if turn in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add(turn)
    return out


def cheapest(turns):
    """Least (cost, audit) over all edits, and the repaired lines; by growing edit strings in order of cost."""
    import heapq

    found = faults(turns)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        if at == len(turns) and GRAMMAR.match(roles):
            return cost, audit, list(lines)
        last = roles[-1:] if roles != "s" else "s"
        if (at, last) in done:
            continue
        done.add((at, last))
        for role in ("user", "assistant"):
            if not re.match(r"s?(ua)*u?\Z", roles + role[0]):
                continue
            heapq.heappush(heap, (cost + 5, audit + "I", at, roles + role[0], (*lines, role + ":")))
            if at < len(turns) and found[at] not in ("blank", "duplicate"):
                extra = 5 * (found[at] == "truncated")
                heapq.heappush(heap, (cost + 1 + extra, audit + "R", at + 1, roles + role[0], (*lines, f"{role}:{turns[at][1]}")))
        if at < len(turns):
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles, lines))
            role, text = turns[at]
            if found[at] not in ("blank", "duplicate") and role and re.match(r"s?(ua)*u?\Z", roles + role[0]):
                heapq.heappush(heap, (cost + 5 * (found[at] == "truncated"), audit + "K", at + 1, roles + role[0], (*lines, f"{role}:{text}")))
    raise AssertionError


def test_walk_is_least_and_first():
    """Every short string of letters, cut into blocks in any way, against all edits."""
    texts = {"ok": "w{}.", "trunc": "w{}", "gone": ""}
    for letters in itertools.chain.from_iterable(itertools.product("suaoSUA1", repeat=n) for n in range(1, 4)):
        word = "".join(letters)
        turns = []
        for i, c in enumerate(word):
            role = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}[turn_repair.MUST_GO.get(c, c.lower())]
            turns.append((role, texts["gone" if c.isdigit() else "trunc" if c.isupper() else "ok"].format(i)))
        cost, audit, _ = cheapest(turns)
        pieces, state = turn_repair.walk(word, turn_repair.END, 0, True)
        assert state in (0, 3) and "".join(turn_repair.INITIALS[c] for p in pieces for c in p) == audit
        assert turn_repair.vectors(word, turn_repair.END)[0][0] == cost
        for cut in range(1, len(word)):
            behind = turn_repair.vectors(word[cut:], turn_repair.END)[0]
            first, middle = turn_repair.walk(word[:cut], behind, 0, False)
            assert first + turn_repair.walk(word[cut:], turn_repair.END, middle, True)[0] == pieces
            m = turn_repair.matrix(word[:cut])
            assert min(m[0][t] + behind[t] for t in range(4)) == cost


def awkward_turns(seed=2):
    rng = random.Random(seed)
    rows = []
    for c in [*range(60), None, 61, 62]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 13])):
            role = rng.choice(["system"] * (turn == 0) + ["user", "assistant"] * 3 + ["tool", "", None])
            text = rng.choice(["", " \n", None, "same.", "end!", "no end", "é?", "a. \t", f"t{rng.random()}.", f"t{rng.random()}"])
            rows.append((c, rng.choice([turn, turn, turn, turn + 1, None]), role, text))
    rows += [(70, t, "user" if t % 2 == 0 else "assistant", f"{rng.choice(['x', 'y' * 200])}{t}{rng.choice('.!? ')}") for t in range(9000)]  # several blocks
    rows += [(71, t, "user", "a.") for t in range(500)]  # nearly all repeated
    return rows + rows[:9]


def reported(rows):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest())
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted(((i, t, " " if r is None else r, " " if x is None else x) for i, t, r, x in rows if i == c), key=order)
        turns = [(r, x) for _, _, r, x in mine]
        found, cost_audit = faults(turns), cheapest(turns)
        numbers = [t for _, t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(turns))
        digest = hashlib.sha256("\n".join(cost_audit[2]).encode()).hexdigest()
        out[c] = (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, *cost_audit[:2], digest)
    return out


def test_repair_against_search(spark):
    rows = awkward_turns()
    frame = spark.createDataFrame([(*r, 1, "z", 3) for r in rows], "conv_id long, turn long, role string, text string, nr long, piece string, block int").repartition(6)
    ids = spark.createDataFrame([(c,) for c in {r[0] for r in rows}] + [(99,)], "conv_id long")
    found = {r[0]: tuple(r)[1:] for r in turn_repair.report(frame, ids).collect()}
    assert found.pop(99) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    expected = reported(rows)
    assert {c for c in expected if found[c] != expected[c]} == set() and len(found) == len(expected)


def test_damage(spark):
    rows = [(c, t, "assistant", f"{c}. {t}!") for c in range(40) for t in range(6)] + [(None, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = []
    for c, t, role, text in rows:
        c, t, role, text = (" " if x is None else x for x in (c, t, role, text))
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        expected += [("user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted((r.role, r.text) for r in turn_repair.damaged(frame).collect()) == sorted(expected)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.report(none, none.select("conv_id")).collect() == []
