"""Exact top-k search over binary codes by incremental multi-index hashing.

Vectors become binary codes: bit i says whether component i lies above its mean over all vectors. A code is cut into m segments of about
log2(n) bits, and an index lists every distinct code under each of its segment values. A query probes all segments with growing radius: in
round r with all values that differ from its own in exactly r bits. After round r every code within distance m(r+1)-1 has been verified, by
the pigeonhole principle; a query is done when its k-th verified distance is at most that. Nothing is approximate: the result equals a scan.

A code that several segments lead to is verified once, in the first round and by the first segment that reach it. Vectors with equal codes
are one index entry that holds their k+1 smallest ids, and equal queries are one search, so a vector that fills a third of the table
is one posting. Candidates beyond the k-th distance known so far are dropped before anything is shuffled.

Defined results: a null vector is not indexed and finds nothing; null or absent components count as not above the mean. A query does not
find itself. Ties go to the smaller id. Fewer than k other vectors give all of them. Rows that repeat an id and vector count once.
Rows with a null id are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deltaloom.llm.vectors import partitions_of
from deltaloom.storage import cut_lineage


def codes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, int]:
    """Frame (id, w0, w1, ...) of codes in 64-bit words, and the number of bits."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v")).where("id is not null and v is not null")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    if not dims:
        return rows.select("id", F.lit(0).cast("long").alias("w0")).limit(0), 1
    component = lambda i: F.get("v", F.lit(i)).cast("double")
    means = rows.agg(*[F.round(F.avg(F.when(~F.isnan(component(i)), component(i))), 6).alias(f"m{i}") for i in range(dims)]).first()
    words = []
    for at in range(0, dims, 64):
        above = F.array(*[F.lit(means[i] or 0.0) for i in range(at, min(at + 64, dims))])
        bits = F.zip_with(F.slice("v", at + 1, 64), above, lambda x, m: F.coalesce((x > m) & ~F.isnan(x), F.lit(False)))
        places = F.transform(bits, lambda b, i: F.when(b, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        words.append(F.aggregate(places, F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x)).alias(f"w{at // 64}"))
    return rows.select("id", *words).distinct(), dims


def _segments(bits: int, n: int) -> list[list[tuple[int, int, int, int]]]:
    """Segments as parts (word, offset in it, width, place in the value): about log2(n) bits each, none crosses a word but by parts."""
    m = max(1, min(bits, round(bits / max(1.0, math.log2(max(2, n))))), math.ceil(bits / 30))
    edges = [bits * j // m for j in range(m + 1)]
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        parts, at = [], a
        while at < b:
            upto = min(b, (at // 64 + 1) * 64)
            parts.append((at // 64, at % 64, upto - at, at - a))
            at = upto
        out.append(parts)
    return out


def _value(prefix: str, parts) -> Column:
    """A segment's value out of the words."""
    value = F.lit(0).cast("long")
    for word, offset, width, place in parts:
        piece = F.shiftrightunsigned(F.col(f"{prefix}{word}"), offset).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        value = value.bitwiseOR(F.shiftleft(piece, place))
    return value


def _flips(probes: DataFrame, radius: int) -> DataFrame:
    """Every probe with exactly ``radius`` of its ``width`` bits flipped."""
    # a few probes become very many, so they are dealt out before each flip
    probes = probes.withColumn("_last", F.lit(-1))
    for left in range(radius, 0, -1):
        probes = probes.repartition(partitions_of(probes))
        places = F.when(F.col("width") - left >= F.col("_last") + 1, F.sequence(F.col("_last") + 1, F.col("width") - left))
        probes = probes.withColumn("_last", F.explode(places)).withColumn(
            "value", F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_last")))
        )
    return probes.drop("_last")


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Frame (query_id, rank, neighbour_id, distance): the ``k`` nearest codes of each query id, a frame (query_id) of ids in ``vectors``."""
    found, bits = codes(vectors, vec_id, embedding)
    found = cut_lineage(found, "codes")
    words = found.columns[1:]
    smallest = W.partitionBy(*words).orderBy("id")
    few = found.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1)
    classes = cut_lineage(few.groupBy(*words).agg(F.array_sort(F.collect_list("id")).alias("ids")), "code-classes")  # k+1 ids at most
    segments = _segments(bits, classes.count())
    everything = found.select("id").distinct().count()

    asked = found.join(queries.select(F.col("query_id").cast("long").alias("query_id")).distinct(), F.col("id") == F.col("query_id"), "left_semi")
    asked = cut_lineage(asked, "queries")
    mine = lambda words: [F.col(w).alias(f"q{w[1:]}") for w in words]
    active = asked.select(*mine(words)).distinct().withColumn("bound", F.lit(bits))
    entries = classes.withColumn(
        "s", F.explode(F.array(*[F.struct(F.lit(j).alias("segment"), _value("w", parts).alias("value")) for j, parts in enumerate(segments)]))
    ).select(F.col("s.segment").alias("i_segment"), F.col("s.value").alias("i_value"), *words, "ids")
    entries = cut_lineage(entries, "code-index")
    q = [f"q{w[1:]}" for w in words]
    best, done = None, []
    for radius in range(max(sum(p[2] for p in parts) for parts in segments) + 1):
        starts = [
            F.struct(F.lit(j).alias("segment"), _value("q", parts).alias("value"), F.lit(sum(p[2] for p in parts)).alias("width")) for j, parts in enumerate(segments)
        ]
        probes = _flips(active.withColumn("s", F.explode(F.array(*starts))).select(*q, "bound", "s.segment", "s.value", "s.width"), radius)
        # Spark takes the flips for as few rows as their queries and would broadcast them
        met = probes.join(entries.hint("merge"), (F.col("segment") == F.col("i_segment")) & (F.col("value") == F.col("i_value")))
        distance = sum((F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(q, words, strict=True)), F.lit(0))
        met = met.withColumn("distance", distance).where(F.col("distance") <= F.col("bound"))
        apart = [F.bit_count(_value("q", parts).bitwiseXOR(_value("w", parts))) for parts in segments]
        first = F.lit(True)  # no segment is nearer, and no earlier one as near
        for j, d in enumerate(apart):
            first = first & (d >= radius) & ((F.col("segment") <= j) | (d > radius))
        fresh = met.where(first).select(*q, "distance", F.explode("ids").alias("id"))
        nearest = W.partitionBy(*q).orderBy("distance", "id")
        fresh = fresh if best is None else fresh.unionByName(best)
        best = cut_lineage(fresh.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k + 1).select(*q, "distance", "id"), "nearest")
        covered = len(segments) * (radius + 1) - 1
        state = best.groupBy(*[F.col(c).alias(f"b{c}") for c in q]).agg(F.count("*").alias("n"), F.max("distance").alias("furthest"))
        state = active.drop("bound").join(state, [F.col(c) == F.col(f"b{c}") for c in q], "left")
        ready = ((F.coalesce("n", F.lit(0)) > k) & (F.col("furthest") <= covered)) | (F.coalesce("n", F.lit(0)) >= everything)
        state = cut_lineage(state.select(*q, F.when(F.col("n") > k, F.col("furthest")).otherwise(F.lit(bits)).alias("bound"), F.coalesce(ready, F.lit(False)).alias("ready")), "search")
        done.append(best.join(state.where("ready").select(*q), q, "left_semi"))
        best = best.join(state.where(~F.col("ready")).select(*q), q, "left_semi")
        active = state.where(~F.col("ready")).drop("ready")
        if active.isEmpty():
            break
    done.append(best)
    lists = done[0]
    for more in done[1:]:
        lists = lists.unionByName(more)
    pairs = asked.select(F.col("id").alias("query_id"), *mine(words)).join(lists, q).where(F.col("query_id") != F.col("id"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "id"))
    ranked = pairs.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("neighbour_id"), F.col("distance").cast("long").alias("distance"))
