"""Near-duplicate vectors by NN-descent: links of cosine ``threshold`` or more, and their connected components.

1. Vectors that are equal after scaling to length 1 are one class, represented by the smallest id. Only classes are compared.
2. Start: every class stands in a few sorted orders, by the signs of random projections; rows next to each other in an order are compared, and each
   class keeps its ``k`` nearest as its neighbour list. Orders are cut into windows of fixed size, so a crowd of similar rows fills many
   windows instead of one.
3. Descent: at every class, those on its list and those on whose lists it stands are compared with each other (neighbours of neighbours), as long as one
   of the two came newly to a list; each of them keeps the better ones. Classes on very many lists are compared in parts, none is left
   out. The descent ends when lists gain hardly any link.
4. Links give components. A list with nothing but links is saturated: the rest of its component crowds out what lies beyond. Such lists are enlarged
   by neighbours outside their component, found by the same start and descent among members drawn from the saturated components, until no
   new component is met.
5. Within a component links are counted exactly, whatever the lists held: components are dealt into blocks, and a ball around the whole component or around two
   blocks often decides by the triangle inequality that all their pairs link, or none. Other blocks are multiplied; only counts leave a task, never
   pairs. A crowd of near copies is one ball and takes linear time.
6. Audit: for a sample of ``SAMPLE`` classes the links among all vectors are counted by brute force. Below ``RECALL``, start and descent run again with
   lists twice as long and other projections, and add to the links found.

Links are decided in double precision: the search runs on 32-bit copies, and pairs within ``MARGIN`` of the threshold are computed again.

Defined results: null vectors, vectors without length, or with null or non-finite components link with nothing; they are their own component. Vectors of
unequal length are compared as if the shorter ones ended in zeros. Rows that repeat an id repeat its result; if their vectors differ, the smallest
counts. A row with a null id has no links and a null component. Other columns are not touched. Links found are true links; a link between
components that the search misses is missing (measured recall: see README).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from deltaloom.llm.components import components
from deltaloom.llm.vectors import finite, matrix, one_row_per_id, partitions_of
from deltaloom.storage import cut_lineage

#: Rows compared with each other in one sorted order, and in one block of a component.
WINDOW, BLOCK = 256, 256
#: Sorted orders of the start.
ORDERS = 6
#: Classes of the audit, and the recall that ends the search.
SAMPLE, RECALL = 1000, 0.98
#: Doubtful distance of a 32-bit cosine from the threshold, and of an angle (radians) from a certain one.
MARGIN, SLACK = 1e-4, 1e-6
#: Share of the links by which they must grow for another step of the descent.
GROWTH = 0.001


def units(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """Frame (id, key, u): vectors of length 1 as packed doubles, with a digest; and their number of components."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & finite(F.col("v"))).select("id", F.transform("v", lambda x: x.cast("double")).alias("v"))
    rows = cut_lineage(one_row_per_id(rows, partitions_of(vectors)), "vectors")
    dims = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), dims, np.float64)
            most = np.abs(v).max(axis=1)
            kept = np.flatnonzero(most > 0)
            v = v[kept] / most[kept, None]  # so that no square overflows
            v = v / np.sqrt((v * v).sum(axis=1, keepdims=True)) + 0.0
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(kept)), _pack(v)], ["id", "u"])

    return rows.mapInArrow(run, "id long, u binary").select("id", F.md5("u").alias("key"), "u"), dims


def _pack(v: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    size = v.shape[1] * v.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(v), [None, pa.py_buffer(np.ascontiguousarray(v))]).cast(pa.binary())


def _unpack(column: pa.Array, dtype, dims: int) -> np.ndarray:
    """The matrix of packed rows."""
    if not len(column):
        return np.zeros((0, dims), dtype)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    begin = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return data[begin : begin + len(column) * dims * np.dtype(dtype).itemsize].view(dtype).reshape(-1, dims)


def _as_floats(nodes: DataFrame, dims: int) -> DataFrame:
    """Packed doubles ``u`` as packed 32-bit numbers ``x``; the other columns stay."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for u in batches:
            yield _pack(_unpack(u, np.float64, dims).astype(np.float32)) if len(u) else pa.array([], pa.binary())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return nodes.withColumn("x", F.arrow_udf(run, "binary")(F.col("u"))).drop("u")


def _best_of(cosines: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Places (..., row, column) of each row's ``k`` largest allowed entries."""
    held = np.where(allowed, cosines, -2.0)
    if held.shape[-1] > k:
        least = np.partition(held, -k, axis=-1)[..., -k, None]
        allowed = allowed & (held >= least)
    return np.nonzero(allowed)


class _Found:
    """Candidates (p, q, c) of a task: the best ``k`` distinct partners of each p are kept whenever many have come together."""

    def __init__(self, k: int, most: int = 1 << 20):
        self.k, self.most, self.held = k, most, 0
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, p: np.ndarray, q: np.ndarray, c: np.ndarray) -> None:
        self.parts.append((p, q, c.astype(np.float64)))
        self.held += len(p)

    def full(self) -> bool:
        return self.held > self.most

    def take(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        p, q, c = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        order = np.lexsort((q, -c, p))
        p, q, c = p[order], q[order], c[order]
        fresh = np.r_[True, (p[1:] != p[:-1]) | (q[1:] != q[:-1])]
        p, q, c = p[fresh], q[fresh], c[fresh]
        begins = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        kept = np.arange(len(p)) - np.repeat(begins, np.diff(np.r_[begins, len(p)])) < self.k
        p, q, c = p[kept], q[kept], c[kept]
        for at in range(0, len(p), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(z[at : at + 10_000]) for z in (p, q, c)], ["p", "q", "c"])


def _start(nodes: DataFrame, dims: int, count: int, k: int, orders: int, seed: int) -> DataFrame:
    """Candidates (p, q, c) from neighbours in sorted orders; ``nodes`` has (id, grp, x), and members of one ``grp`` are not compared."""
    bits = min(40, max(1, round(math.log2(max(2, count / WINDOW)))))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).standard_normal((orders, dims, bits + 1)).astype(np.float32)
        for batch in batches:
            x = _unpack(batch.column("x"), np.float32, dims)
            for nth in range(orders):
                seen = x @ planes[nth]
                key = ((seen[:, :bits] > 0) << np.arange(bits)).sum(axis=1, dtype=np.int64) << 16
                key += np.clip(np.round(seen[:, bits] * 4096) + 32768, 0, 65535).astype(np.int64)
                ids = pa.array(np.full(len(x), nth, np.int32)), pa.array(key)
                yield pa.RecordBatch.from_arrays([*ids, batch.column("id"), batch.column("grp"), batch.column("x")], ["nth", "key", "id", "grp", "x"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found(k)
        for batch in batches:
            nth, ids, grp = (np.asarray(batch.column(c)) for c in ("nth", "id", "grp"))
            x = _unpack(batch.column("x"), np.float32, dims)
            for a in range(0, len(ids), WINDOW):
                part = slice(a, a + WINDOW)
                c = x[part] @ x[part].T
                apart = (grp[part, None] != grp[part]) & (nth[part, None] == nth[part])
                i, j = _best_of(c, apart, k)
                found.add(ids[part][i], ids[part][j], c[i, j])
            if found.full():
                yield from found.take()
        yield from found.take()

    dealt = cut_lineage(nodes.select("id", "grp", "x").mapInArrow(keys, "nth int, key long, id long, grp long, x binary"), "orders")
    dealt = dealt.repartitionByRange(partitions_of(nodes), "nth", "key", "id").sortWithinPartitions("nth", "key", "id")
    return dealt.mapInArrow(windows, "p long, q long, c double")


def _lists(candidates: DataFrame, k: int) -> DataFrame:
    """Neighbour lists (id, nbr, c, fresh) of the best ``k`` candidates; an entry that stood on a list before is not fresh."""
    once = candidates.groupBy(F.col("p").alias("id"), F.col("q").alias("nbr")).agg(F.max("c").alias("c"), F.min("fresh").alias("fresh"))
    order = W.partitionBy("id").orderBy(F.desc("c"), "nbr")
    return once.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def _meetings(lists: DataFrame, k: int) -> DataFrame:
    """Who is compared at whom: frame (u, part, v, fresh). Those on whose lists u stands are dealt into parts of about ``k``; u's own list joins every part."""
    parts = lists.groupBy(F.col("nbr").alias("of")).agg(F.ceil(F.count("*") / F.lit(k)).cast("int").alias("parts"))
    known = lambda side: side.join(parts.hint("merge"), F.col("u") == F.col("of"), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = known(lists.select(F.col("id").alias("u"), F.col("nbr").alias("v"), "fresh"))
    own = own.select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "v", "fresh")
    back = known(lists.select(F.col("nbr").alias("u"), F.col("id").alias("v"), "fresh"))
    back = back.select("u", F.pmod(F.hash("v"), F.col("parts")).alias("part"), "v", "fresh")
    return own.unionByName(back)


def _complete(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables of whole groups, with the places where groups begin; a group that runs over a batch's border waits for its end."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        changed = np.zeros(table.num_rows, bool)
        changed[0] = True
        for key in keys:
            values = np.asarray(table[key])
            changed[1:] |= values[1:] != values[:-1]
        begins = np.flatnonzero(changed)
        rest = table.slice(begins[-1])
        if len(begins) > 1:
            yield table.slice(0, begins[-1]).combine_chunks(), begins[:-1]
    if rest is not None:
        yield rest.combine_chunks(), np.zeros(1, np.int64)


def _compare(meetings: DataFrame, nodes: DataFrame, lists: DataFrame, dims: int, k: int, threshold: float) -> DataFrame:
    """Candidates (p, q, c) among those who meet, better than the last on p's list; saturated lists take no more."""
    least = lists.groupBy(F.col("id").alias("of")).agg(F.when(F.count("*") >= k, F.min("c")).otherwise(-1.5).alias("least"))
    known = nodes.join(least.hint("merge"), F.col("id") == F.col("of"), "left").select("id", "grp", "x", F.coalesce("least", F.lit(-1.5)).alias("least"))
    there = meetings.hint("merge").join(known, F.col("v") == F.col("id")).select("u", "part", "id", "grp", "fresh", "least", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found(k)
        for table, begins in _complete(batches, ["u", "part"]):
            ids, grp, least = (np.asarray(table[c]) for c in ("id", "grp", "least"))
            fresh = np.asarray(table["fresh"]).astype(bool)
            x = _unpack(table["x"].chunk(0), np.float32, dims)
            sizes = np.diff(np.r_[begins, len(ids)])
            by_size = np.argsort(sizes, kind="stable")
            at = 0
            while at < len(by_size):
                upto = at + 1  # groups of like size, padded to the largest, in some megabytes
                while upto < len(by_size) and (upto + 1 - at) * int(sizes[by_size[upto]]) * max(dims, int(sizes[by_size[upto]])) <= 1 << 20:
                    upto += 1
                some = by_size[at:upto]
                most = int(sizes[some].max())
                place = begins[some, None] + np.arange(most)
                there = np.arange(most) < sizes[some, None]
                place = np.where(there, place, 0)
                c = np.matmul(x[place], x[place].transpose(0, 2, 1))
                apart = there[:, :, None] & there[:, None, :] & (grp[place][:, :, None] != grp[place][:, None, :])
                useful = (fresh[place][:, :, None] | fresh[place][:, None, :]) & (c > least[place][:, :, None]) & (least[place] < threshold)[:, :, None]
                g, i, j = _best_of(c, apart & useful, k)
                found.add(ids[place[g, i]], ids[place[g, j]], c[g, i, j])
                at = upto
            if found.full():
                yield from found.take()
        yield from found.take()

    dealt = there.repartition(partitions_of(nodes), "u", "part").sortWithinPartitions("u", "part")
    return dealt.mapInArrow(run, "p long, q long, c double")


def _descend(nodes: DataFrame, dims: int, k: int, orders: int, threshold: float, seed: int) -> DataFrame:
    """Neighbour lists (id, nbr, c, fresh) of ``nodes`` (id, grp, x) outside each one's ``grp``."""
    count = nodes.count()
    lists = cut_lineage(_lists(_start(nodes, dims, count, k, orders, seed).withColumn("fresh", F.lit(True)), k), "neighbours")
    links = lambda: lists.where(F.col("c") >= threshold).count()
    had = links()
    while True:
        candidates = _compare(_meetings(lists, k), nodes, lists, dims, k, threshold).withColumn("fresh", F.lit(True))
        old = lists.select(F.col("id").alias("p"), F.col("nbr").alias("q"), "c", F.lit(False).alias("fresh"))
        lists = cut_lineage(_lists(candidates.unionByName(old), k), "neighbours")
        now = links()
        if now - had <= GROWTH * now:
            return lists
        had = now


def _links(lists: DataFrame, classes: DataFrame, dims: int, threshold: float) -> DataFrame:
    """Links (a, b) of neighbour lists; the doubtful ones are decided in double precision."""
    pairs = lists.where(F.col("c") >= threshold - MARGIN).select(F.greatest("id", "nbr").alias("a"), F.least("id", "nbr").alias("b"), "c")
    pairs = cut_lineage(pairs.groupBy("a", "b").agg(F.max("c").alias("c")), "near-pairs")
    left, right = (classes.select(F.col("id").alias(c), F.col("u").alias(f"u_{c}")) for c in ("a", "b"))
    doubtful = pairs.where(F.col("c") < threshold + MARGIN).hint("merge").join(left, "a").hint("merge").join(right, "b")

    def exact(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            yield pa.array((_unpack(a, np.float64, dims) * _unpack(b, np.float64, dims)).sum(axis=1) >= threshold)

    exact.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    decided = doubtful.withColumn("linked", F.arrow_udf(exact, "boolean")("u_a", "u_b")).where("linked")
    return pairs.where(F.col("c") >= threshold + MARGIN).select("a", "b").unionByName(decided.select("a", "b"))


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _count(members: DataFrame, dims: int, threshold: float) -> DataFrame:
    """Frame (id, links): the weight of other members of its component that each member links with. ``members`` has (id, comp, weight, u)."""
    sizes = members.groupBy(F.col("comp").alias("of")).agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    placed = members.join(sizes.hint("merge"), F.col("comp") == F.col("of")).drop("of")
    placed = placed.withColumn("block", F.pmod(F.hash("id"), F.col("blocks")))
    dealt = placed.repartition(partitions_of(members), "comp", "block").sortWithinPartitions("comp", "block", "id")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packs every block into one row, with the links inside it."""
        for table, begins in _complete(batches, ["comp", "block"]):
            u = _unpack(table["u"].chunk(0), np.float64, dims)
            weight, rows = np.asarray(table["weight"]), []
            for a, b in zip(begins, np.r_[begins[1:], len(u)], strict=True):
                linked = u[a:b] @ u[a:b].T >= threshold
                np.fill_diagonal(linked, False)
                rows.append((linked @ weight[a:b], u[a:b].sum(axis=0)))
            ends = pa.array(np.r_[begins, len(u)], pa.int32())
            listed = lambda values, ends=ends: pa.ListArray.from_arrays(ends, pa.array(values))
            packed = [np.ascontiguousarray(u[a:b]).tobytes() for a, b in zip(begins, np.r_[begins[1:], len(u)], strict=True)]
            first = [table[c].chunk(0).take(pa.array(begins)) for c in ("comp", "block", "blocks")]
            sums = pa.array([s.tolist() for _, s in rows], pa.list_(pa.float64()))
            lists = [listed(np.asarray(table["id"])), listed(weight), listed(np.concatenate([r for r, _ in rows]))]
            out = pa.RecordBatch.from_arrays([*first, *lists, pa.array(packed, pa.binary()), sums], _BLOCKS)
            for at in range(out.num_rows):  # a row may hold some megabytes
                yield out.slice(at, 1) if out.num_rows * dims > 4096 else out
                if out.num_rows * dims <= 4096:
                    break

    blocks = cut_lineage(dealt.mapInArrow(gather, ", ".join(f"{c} {t}" for c, t in zip(_BLOCKS, _BLOCK_TYPES, strict=True))), "blocks")
    each = lambda frame, value: frame.select(F.explode(F.arrays_zip("ids", value)).alias("z")).select("z.ids", f"z.{value}").toDF("id", "links")
    wide = blocks.where("blocks > 1")
    if wide.isEmpty():
        return each(blocks, "inside")

    # one ball around the whole component: its pairs all link if any two of its members are near enough by way of the centre
    sums = wide.select("comp", F.posexplode("sums").alias("at", "s")).groupBy("comp", "at").agg(F.sum("s").alias("s"))
    centres = sums.groupBy(F.col("comp").alias("of")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "s"))), lambda z: z["s"]).alias("centre"))
    totals = wide.groupBy(F.col("comp").alias("of2")).agg(F.sum(F.aggregate("weights", F.lit(0).cast("long"), lambda s, w: s + w)).alias("total"))
    near = cut_lineage(_with_radius(wide.join(centres.hint("merge"), F.col("comp") == F.col("of")), "centre", "u", dims).select("comp", "block", "radius"), "radii")
    limit = math.acos(threshold)
    balls = near.groupBy(F.col("comp").alias("of")).agg(F.max("radius").alias("radius")).join(totals, F.col("of") == F.col("of2"))
    balls = cut_lineage(balls.select("of", "total", (2 * F.col("radius") <= limit - SLACK).alias("tight")), "balls")
    told = wide.join(balls.hint("merge"), F.col("comp") == F.col("of"))
    tight = told.where("tight").withColumn("links", F.transform("weights", lambda w: F.col("total") - w))
    out = each(blocks.where("blocks = 1"), "inside").unionByName(each(tight, "links"))

    # other components: pairs of blocks, decided by their balls where these are far apart or close together
    loose = cut_lineage(_with_radius(told.where("not tight").withColumn("centre", F.col("sums")), "centre", "u", dims).drop("of", "total", "tight"), "loose-blocks")
    if loose.isEmpty():
        return out
    total = F.aggregate("weights", F.lit(0).cast("long"), lambda s, w: s + w)
    small = loose.select("comp", "block", "centre", "radius", total.alias("weight"))
    x, y = (small.select(F.col("comp").alias("c") if s == 1 else "comp", *[F.col(c).alias(f"{c}{s}") for c in ("block", "centre", "radius", "weight")]) for s in (1, 2))
    pairs = x.join(y.hint("merge"), (F.col("c") == F.col("comp")) & (F.col("block1") < F.col("block2"))).drop("c")
    size = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, z: s + z * z))
    dot = F.aggregate(F.zip_with("centre1", "centre2", lambda a, b: a * b), F.lit(0.0), lambda s, z: s + z)
    between = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / (size("centre1") * size("centre2")))))
    reach = F.col("radius1") + F.col("radius2")
    pairs = pairs.withColumn("all", between + reach <= limit - SLACK).withColumn("none", between - reach > limit + SLACK)
    pairs = cut_lineage(pairs.where(~F.coalesce("none", F.lit(False))).select("comp", "block1", "block2", "weight1", "weight2", F.coalesce("all", F.lit(False)).alias("all")), "block-pairs")
    certain = pairs.where("all")
    sides = certain.select("comp", F.col("block1").alias("block"), F.col("weight2").alias("w"))
    sides = sides.unionByName(certain.select("comp", F.col("block2").alias("block"), F.col("weight1").alias("w")))
    given = sides.groupBy(F.col("comp").alias("of"), F.col("block").alias("at")).agg(F.sum("w").alias("w"))
    with_given = loose.join(given, (F.col("comp") == F.col("of")) & (F.col("block") == F.col("at")), "left")
    own = with_given.withColumn("links", F.transform("inside", lambda n: n + F.coalesce(F.col("w"), F.lit(0))))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = (np.frombuffer(row[f"u{s}"], np.float64).reshape(-1, dims) for s in (1, 2))
                linked = a @ b.T >= threshold
                links = np.r_[linked @ np.array(row["weights2"]), linked.T @ np.array(row["weights1"])]
                yield pa.RecordBatch.from_arrays([pa.array(row["ids1"] + row["ids2"], pa.int64()), pa.array(links, pa.int64())], ["id", "links"])

    sides = [loose.select(F.col("comp").alias(f"c{s}"), F.col("block").alias(f"b{s}"), *[F.col(c).alias(f"{c}{s}") for c in ("ids", "weights", "u")]) for s in (1, 2)]
    open_pairs = pairs.where("not all").select("comp", "block1", "block2")
    for s, side in enumerate(sides, 1):
        open_pairs = open_pairs.hint("merge").join(side, (F.col("comp") == F.col(f"c{s}")) & (F.col(f"block{s}") == F.col(f"b{s}")))
    columns = [f"{c}{s}" for s in (1, 2) for c in ("ids", "weights", "u")]
    across = open_pairs.select(*columns).mapInArrow(multiply, "id long, links long")
    return out.unionByName(each(own, "links").unionByName(across).groupBy("id").agg(F.sum("links").alias("links")))


_BLOCKS = ["comp", "block", "blocks", "ids", "weights", "inside", "u", "sums"]
_BLOCK_TYPES = ["long", "int", "int", "array<long>", "array<long>", "array<long>", "binary", "array<double>"]


def _with_radius(blocks: DataFrame, centre: str, vectors: str, dims: int) -> DataFrame:
    """Adds ``radius``, the largest angle between a block's vectors and its centre (a right angle and more if there is no centre)."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for centres, packed in batches:
            out = []
            for c, p in zip(centres, packed, strict=True):
                c, u = np.array(c.as_py()), np.frombuffer(p.as_buffer(), np.float64).reshape(-1, dims)
                length = np.sqrt((c * c).sum())
                out.append(float(_angle(u @ (c / length)).max()) if length > 1e-9 else math.pi)
            yield pa.array(out, pa.float64())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return blocks.withColumn("radius", F.arrow_udf(run, "double")(centre, vectors))


def _true_links(sample: DataFrame, classes: DataFrame, dims: int, threshold: float) -> DataFrame:
    """Frame (id, true_links) by brute force: the weight of all classes that each of at most SAMPLE classes links with, itself included."""
    rows = sample.toArrow()  # SAMPLE rows at most
    ids = np.asarray(rows["id"])
    asked = _unpack(rows["u"].combine_chunks(), np.float64, dims) if len(ids) else np.zeros((0, dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            u, weight = _unpack(batch.column("u"), np.float64, dims), np.asarray(batch.column("weight"))
            for at in range(0, len(u), 2048):
                total += (asked @ u[at : at + 2048].T >= threshold) @ weight[at : at + 2048]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["id", "links"])

    return classes.select("u", "weight").mapInArrow(run, "id long, links long").groupBy("id").agg(F.sum("links").alias("true_links"))


def link(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9, k: int = 12) -> DataFrame:
    """Frame (vec_id, n_links, component_id, kept), one row per row of ``vectors``: how many other vectors each is linked with, the smallest id reachable by links, and whether that is its own."""
    found, dims = units(vectors, vec_id, embedding)
    found = cut_lineage(found, "units")
    classes = cut_lineage(found.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("weight"), F.first("u").alias("u")), "classes")
    nodes = cut_lineage(_as_floats(classes.select("id", F.col("id").alias("grp"), "u"), dims), "nodes")
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "u")
    truth = cut_lineage(_true_links(sample, classes, dims, threshold), "audit")

    links, seed, orders = None, 1, ORDERS
    while True:
        lists = _descend(nodes, dims, k, orders, threshold, seed)
        links, found_comps = _grown(links, _links(lists, classes, dims, threshold))
        crowded = lists.groupBy("id").agg(F.count_if(F.col("c") >= threshold).alias("n")).where(F.col("n") >= k).select("id")
        while True:  # lists with nothing but links: enlarged by neighbours beyond their component
            beyond = _beyond(nodes, found_comps, crowded, 4 * k)
            if beyond.agg(F.count_distinct("grp")).first()[0] < 2:
                break
            more = _links(_descend(beyond, dims, k, orders, threshold, seed + 1), classes, dims, threshold)
            if more.isEmpty():
                break
            links, found_comps = _grown(links, more)
        member = classes.join(found_comps.hint("merge"), F.col("id") == F.col("node")).select("id", F.col("component").alias("comp"), "weight", "u")
        counts = cut_lineage(_count(member, dims, threshold), "links")
        seen = truth.join(classes.select("id", F.col("weight").alias("own")), "id").join(counts, "id", "left")
        share = (F.coalesce("links", F.lit(0)) / (F.col("true_links") - F.col("own"))).alias("share")
        recall = seen.where("true_links > own").agg(F.avg(share)).first()[0]
        if recall is None or recall >= RECALL:
            break
        k, orders, seed = 2 * k, 2 * orders, seed + 2

    per_class = classes.select("key", "id", "weight").join(counts.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
    per_class = per_class.join(found_comps, F.col("id") == F.col("node"), "left").select(
        "key", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "id").alias("comp")
    )
    told = found.select("id", "key").join(per_class.hint("merge"), "key").select("id", "n", "comp")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"))
    out = rows.join(told.hint("merge"), F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("comp", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _grown(links: DataFrame | None, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links so far and their components (node, component)."""
    links = cut_lineage(more if links is None else links.unionByName(more).distinct(), "links")
    return links, cut_lineage(components(links), "components")


def _beyond(nodes: DataFrame, comps: DataFrame, crowded: DataFrame, members: int) -> DataFrame:
    """About ``members`` nodes of each component that has a saturated list, the component as their ``grp``."""
    full = comps.join(crowded, F.col("node") == F.col("id"), "left_semi").select(F.col("component").alias("of")).distinct()
    sizes = comps.groupBy("component").agg(F.count("*").alias("n")).join(full, F.col("component") == F.col("of"), "left_semi")
    some = comps.join(sizes.withColumnRenamed("component", "of").hint("merge"), F.col("component") == F.col("of"))
    some = some.where(F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / F.lit(members))) == 0).select("node", "component")
    return cut_lineage(nodes.join(some.hint("merge"), F.col("id") == F.col("node")).select("id", F.col("component").alias("grp"), "x"), "beyond")
