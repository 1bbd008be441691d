"""Hard-negative mining with exact integer scores from Kronecker-packed products.

A vector's components become whole numbers, ``floor(scale * x)``. The score of two rows is their inner product. Several candidates are scored by
one multiplication per component of the anchor: their components, biased to be nonnegative, stand in separated fields of one 64-bit integer, wide
enough for the largest inner product that can occur. The sum over components of ``anchor component * packed integer`` then holds every
candidate's inner product in its field; subtracting ``bias * sum of the anchor`` gives the exact score. How many fields fit follows from the
numbers at hand: three for unit vectors of 64 components at a scale of 256.

Two passes over all rows. The first finds each anchor's best rows of its own label, the positives. Their scores set, for each pair of anchor and
positive, the range in which a row of another label is a hard negative; the second pass finds the best in that range. A task keeps, for every
anchor (and positive), only its best few so far, and returns them when its rows are read, so what is shuffled is a few rows per anchor and task.

Anchors are compared with all rows, in rounds of at most ``ROUND`` bytes of anchors that are sent to the tasks; each round reads the rows anew.
A round's packed block and its scores take a few megabytes, whatever the table's size.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part, as anchors or otherwise. Of rows that
repeat an id one counts, the smallest by (label, components). Vectors of unequal length are compared as if the shorter ones ended in zeros; an
empty vector scores 0. Components are limited to +-2^20 after scaling (4096 times a unit vector's largest at the default scale), so that
scores fit 64 bits. Ties go to the smaller id. Labels and ids must be whole numbers; other columns are not touched. An anchor without
positives, or a positive without a row in its range, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deltaloom.llm.vectors import finite, matrix, one_row_per_id, partitions_of
from deltaloom.storage import cut_lineage

#: Bytes of anchors in a round, as 64-bit components.
ROUND = 64 << 20
#: Anchors and candidates scored at a time.
ANCHORS, CANDIDATES = 128, 3072
#: Largest size of a component after scaling.
LIMIT = 1 << 20


def quantised(vectors: DataFrame, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """Frame (id, label, q) of the rows that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(embedding).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
    limited = lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))
    rows = rows.select("id", "label", F.transform("v", lambda x: F.floor(limited(x)).cast("int")).alias("q"))
    return one_row_per_id(rows, partitions_of(vectors))


@dataclass
class Packed:
    """Candidates in fields of 64-bit integers: candidate ``f * width + p`` stands in field f of packed integer p."""

    words: np.ndarray  # components x packed integers
    bits: int
    fields: int
    bias: int

    @staticmethod
    def of(q: np.ndarray, reach: int) -> Packed:
        """Pack rows for anchors whose components' absolute values sum to at most ``reach``."""
        bias = int(-q.min())
        u = q + bias
        bits = (reach * int(u.max())).bit_length() + 1
        fields = max(1, 63 // bits)
        width = -(-len(q) // fields)
        u = np.vstack([u, np.zeros((fields * width - len(q), q.shape[1]), np.int64)])
        words = np.zeros((q.shape[1], width), np.int64)
        for f in range(fields):
            words += u[f * width : (f + 1) * width].T << (bits * f)
        return Packed(words, bits, fields, bias)

    def scores(self, anchors: np.ndarray, count: int) -> np.ndarray:
        """Exact inner products, anchors x candidates."""
        half = 1 << (self.bits - 1)  # fields hold negative sums too: lifted here, taken off below
        sums = np.einsum("ad,dp->ap", anchors, self.words) + np.int64(sum(half << (self.bits * f) for f in range(self.fields)))
        mask, back = np.int64((1 << self.bits) - 1), half + self.bias * anchors.sum(axis=1, keepdims=True)
        return np.concatenate([((sums >> (self.bits * f)) & mask) - back for f in range(self.fields)], axis=1)[:, :count]


class Best:
    """The best ``k`` (score, id) of every key: higher scores first, then smaller ids."""

    def __init__(self, keys: int, k: int):
        self.k, self.least = k, np.full(keys, np.iinfo(np.int64).min)
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, key: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        key, score, ident = np.concatenate([self.key, key]), np.concatenate([self.score, score]), np.concatenate([self.id, ident])
        order = np.lexsort((ident, -score, key))
        key, score, ident = key[order], score[order], ident[order]
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        rank = np.arange(len(key)) - np.repeat(begins, np.diff(np.r_[begins, len(key)]))
        kept = rank < self.k
        self.key, self.score, self.id = key[kept], score[kept], ident[kept]
        full = rank == self.k - 1
        self.least[key[full]] = score[full]


@dataclass
class Anchors:
    """A round of anchors. ``low`` and ``high`` bound the scores of each of their slots; ``same`` says whether slots take the anchor's label or others."""

    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    low: np.ndarray  # anchors x slots
    high: np.ndarray
    same: bool
    k: int

    def best(self, batches: Iterator[pa.RecordBatch]) -> Best:
        """The best rows of every slot; slot s of anchor a has the key ``a * slots + s``."""
        slots = self.low.shape[1]
        best = Best(len(self.ids) * slots, self.k)
        reach = max(1, int(np.abs(self.q).sum(axis=1).max()))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, labels = np.asarray(batch.column("id")), np.asarray(batch.column("label"))
            q = matrix(batch.column("q"), self.q.shape[1], np.int64)
            for at in range(0, len(ids), CANDIDATES):
                part = slice(at, at + CANDIDATES)
                packed = Packed.of(q[part], reach)
                found = [self._hits(a, packed, ids[part], labels[part], best.least.reshape(-1, slots)) for a in range(0, len(self.ids), ANCHORS)]
                best.add(*(np.concatenate(x) for x in zip(*found, strict=True)))
        return best

    def _hits(self, a: int, packed: Packed, ids: np.ndarray, labels: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, scores and ids of rows that may be among the best of anchors ``a`` and following."""
        mine = slice(a, a + ANCHORS)
        score = packed.scores(self.q[mine], len(ids))
        low, high = np.maximum(self.low[mine], least[mine]), self.high[mine]
        fits = ((labels == self.labels[mine, None]) == self.same) & (score >= low.min(axis=1, keepdims=True)) & (score <= high.max(axis=1, keepdims=True))
        row, column = np.nonzero(fits & (ids != self.ids[mine, None]))
        keys, scores, found = [], [], []
        for slot in range(low.shape[1]):
            s = score[row, column]
            inside = (s >= low[row, slot]) & (s <= high[row, slot])
            keys.append((row[inside] + a) * low.shape[1] + slot)
            scores.append(s[inside])
            found.append(ids[column[inside]])
        return np.concatenate(keys), np.concatenate(scores), np.concatenate(found)


def _in_rounds(rows: DataFrame, anchors: DataFrame, dims: int, build, schema: str, label: str) -> DataFrame:
    """Best rows per slot of all anchors, ROUND bytes of anchors at a time. ``build`` makes ``Anchors`` of collected rows."""
    spark = rows.sparkSession
    rounds = -(-anchors.count() * dims * 8 * 2 // ROUND)  # ids are distinct and dealt by hash: half full on average
    out = None
    for nth in range(rounds):
        mine = anchors.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == nth)
        table = mine.toArrow()
        if not table.num_rows:
            continue
        shared = spark.sparkContext.broadcast(build(table.combine_chunks()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked = shared.value
            best = asked.best(batches)
            slots = asked.low.shape[1]
            columns = [asked.ids[best.key // slots], (best.key % slots).astype(np.int32), best.score, best.id]
            for at in range(0, len(best.key), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 10_000]) for c in columns], ["anchor_id", "slot", "score", "id"])

        found = cut_lineage(rows.mapInArrow(run, schema), label)
        shared.destroy()
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def mine(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
) -> DataFrame:
    """Frame (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a frame (anchor_id) of ids in ``vectors``. A negative's score lies between ``low`` and ``high`` percent of the positive's.
    """
    schema = "anchor_id long, slot int, score long, id long"
    rows = cut_lineage(quantised(vectors, vec_id, label, embedding, scale), "quantised")
    dims = max(1, rows.agg(F.max(F.size("q"))).first()[0] or 0)
    wanted = anchors.select(F.col("anchor_id").cast("long").alias("of")).distinct()
    asked = cut_lineage(rows.join(wanted, F.col("id") == F.col("of"), "left_semi"), "anchors")
    top = np.iinfo(np.int64).max

    def for_positives(t: pa.Table) -> Anchors:
        n = t.num_rows
        q = matrix(t.column("q").chunk(0), dims, np.int64)
        return Anchors(np.asarray(t["id"]), np.asarray(t["label"]), q, np.full((n, 1), -top), np.full((n, 1), top), True, positives)

    first = _in_rounds(rows, asked, dims, for_positives, schema, "positives")
    order = W.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    chosen = first.withColumn("slot", F.row_number().over(order) - 1).where(F.col("slot") < positives)
    chosen = cut_lineage(chosen.select("anchor_id", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "chosen")

    # the range of 100 * score, rounded inwards to whole scores; an empty range for slots without a positive
    ranges = chosen.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "positive_score"))).alias("scores"))  # ``positives`` entries at most
    scores = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda s: F.try_element_at("scores", s))
    with_ranges = cut_lineage(asked.join(ranges, F.col("id") == F.col("anchor_id")).select("id", "label", "q", scores.alias("scores")), "ranges")

    def for_negatives(t: pa.Table) -> Anchors:
        lists = t.column("scores").chunk(0)
        there = np.asarray(lists.flatten().is_valid()).reshape(-1, positives)
        score = np.asarray(lists.flatten().fill_null(0)).reshape(-1, positives)
        below, above = np.where(there, -((-low * score) // 100), top), np.where(there, high * score // 100, -top)
        return Anchors(np.asarray(t["id"]), np.asarray(t["label"]), matrix(t.column("q").chunk(0), dims, np.int64), below, above, False, negatives)

    second = _in_rounds(rows, with_ranges, dims, for_negatives, schema, "negatives")
    order = W.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    ranked = second.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.join(chosen, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
