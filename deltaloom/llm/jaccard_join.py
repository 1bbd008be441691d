"""Exact Jaccard self-join of documents on word n-grams, by adaptive multi-match prefixes, up to connected components.

1. Every text becomes its set of distinct hashed n-grams. Texts with equal sets are one class, represented by the smallest id.
2. n-grams are ordered by frequency, rarest first; frequencies come from a fixed-size counting sketch over all sets. Any one order gives
   exact results; this one keeps frequent passages out of the prefixes.
3. A set of size n can share at least ``o = ceil(t n)`` elements with a partner only if the two share at least k elements of their prefixes of length
   ``n - o + k``. Each document picks its own k: the one with the least estimated cost, of reading the postings of a longer prefix and verifying
   the candidates a shorter one lets through. Two documents are verified only with the number of shared prefix elements that both prefix
   lengths imply.
4. First each document is compared with one candidate only. Every posting list names its most central document, the one with most shared
   prefix elements; the candidate, the document's hub, is the one named by most of its lists. A group of near copies is linked by as many comparisons
   as it has members.
5. Members of a hub's group that stay apart from it (each has edits of its own, and two sets of edits are too many) would meet each other in
   every element of the text they share. Groups with ``CROWD`` of them or more are joined by their differences instead: a group's common text is the set of
   elements that more than half of its members have, and a member is described by what it lacks of that and what it has besides. The size of two
   members' difference is known exactly from these two sets, so similar members must share a known number of them; members meet only in the rarest of their
   differences, as many as that number implies. Members so near to the common text that they need not share any are compared with the nearest member of
   each size. No text is read again, nothing is dropped, and what is formed grows with the members, not with their square.
6. All other candidate pairs that are not yet in one component are verified by whole texts. Components therefore lose no link, and pairs inside one
   are not enumerated.

Similarity is a fraction of whole numbers, compared in whole numbers.

Defined results: null and empty texts, and texts without words, have empty sets and link with nothing. A text with fewer words than an
n-gram is one element, its whole word sequence. Rows that repeat an id and text repeat their result; rows of one id with different texts link
through that id. A row with a null id gets the component of its class, null if no other row has its set. Sets are compared by 64-bit hashes of their elements.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deltaloom.llm.bitmap import keep_likely, split_likely
from deltaloom.llm.components import components
from deltaloom.llm.text import free_name, mix, octets, sequences, words
from deltaloom.storage import cut_lineage

#: Slots of the frequency sketch, and of one row of it. A byte per slot is broadcast.
SLOTS, RANGE = 1 << 21, 1 << 16
#: Choices of k, and the cost of one verification in postings read.
CHOICES, VERIFY = np.array([1, 2, 4, 8, 16]), 50.0
#: Shared elements by which a pair is found, at most; the others of its prefixes are counted for found pairs only.
EARLY = 4
#: Members of a hub's group in other components than the hub's, from which on the group is joined by differences.
CROWD = 16


def sets(array: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct element hashes of each row."""
    for part in words(array, plain=False):
        runs = sequences(part.hashes, size)
        for a, b in zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(runs[a : b - size + 1])
            else:
                yield sequences(part.hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def _slot(u: np.ndarray) -> np.ndarray:
    return (u & np.uint64(SLOTS - 1)).astype(np.int64)


_DIGEST = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("part", pa.int32()), ("counts", pa.binary())])


def _summarise(docs: DataFrame, size: int) -> DataFrame:
    """Per row its set's size and digest; and per task one compressed row for every range of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, held = np.zeros(SLOTS, np.uint32), [], 0
        any_row = False
        for batch in batches:
            n, hi, lo = [], [], []
            with np.errstate(over="ignore"):
                for u in sets(batch.column("octets"), size):
                    n.append(len(u))
                    hi.append(mix(u + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    lo.append(mix(u ^ np.uint64(0xDA942042E4DD58B5)).sum(dtype=np.uint64))
                    waiting.append(_slot(u))
                    held += len(u)
                    if held > 1 << 19:
                        counts += np.bincount(np.concatenate(waiting), minlength=SLOTS).astype(np.uint32)
                        waiting, held = [], 0
            if n:
                any_row = True
                long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), long(hi), long(lo), *none], schema=_DIGEST)
        if any_row:
            if waiting:
                counts += np.bincount(np.concatenate(waiting), minlength=SLOTS).astype(np.uint32)
            for part in range(SLOTS // RANGE):
                data = zlib.compress(counts[part * RANGE : (part + 1) * RANGE].tobytes(), 1)
                empty = [pa.nulls(1, pa.int64())] * 4
                yield pa.RecordBatch.from_arrays([*empty, pa.array([part], pa.int32()), pa.array([data], pa.binary())], schema=_DIGEST)

    return docs.mapInArrow(run, "id long, n long, hi long, lo long, part int, counts binary")


def _frequencies(summary: DataFrame) -> np.ndarray:
    """Logarithmic code (in eighths of a power of two) of how far each slot's count lies above an average slot's."""

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RANGE, np.int64)
        for batch in batches:
            for data in batch.column("counts"):
                total += np.frombuffer(zlib.decompress(data.as_buffer()), np.uint32)
        yield pa.RecordBatch.from_pydict({"part": pa.array([key[0].as_py()], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())})

    def encode(average: float):
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                out = []
                for x in batch:
                    above = np.maximum(np.frombuffer(x.as_buffer(), np.int64) - average - 3 * average**0.5, 0)
                    out.append(np.minimum(np.round(8 * np.log2(1 + above)), 255).astype(np.uint8).tobytes())
                yield pa.array(out, pa.binary())

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, "binary")

    average = (summary.where("part is null").agg(F.sum("n")).first()[0] or 0) / SLOTS
    totals = summary.where("part is not null").select("part", "counts").groupBy("part").applyInArrow(add, "part int, total binary")
    codes = np.zeros(SLOTS, np.uint8)
    for r in totals.select("part", encode(average)(F.col("total")).alias("codes")).collect():  # SLOTS bytes in all
        codes[r["part"] * RANGE : (r["part"] + 1) * RANGE] = np.frombuffer(r["codes"], np.uint8)
    return codes


def least_overlap(n: int, num: int, den: int) -> int:
    """Elements that a set of ``n`` shares at least with any partner of similarity num/den."""
    return -(-n * num // den)


def prefix(u: np.ndarray, codes: np.ndarray, num: int, den: int) -> np.ndarray:
    """The prefix of a set in the common order, as long as its estimated costs suggest."""
    n = len(u)
    code = codes[_slot(u)]
    order = np.argsort((code.astype(np.uint64) << np.uint64(56)) | (u >> np.uint64(8)), kind="stable")
    least = least_overlap(n, num, den)
    choices = CHOICES[least >= CHOICES]
    lengths = n - least + choices
    others = np.cumsum(np.exp2(code[order[: lengths[-1]]] / 8.0) - 1)
    reading = lengths + others[lengths - 1]
    cost = reading + VERIFY * others[lengths - 1] / choices
    return u[order[: lengths[int(np.argmin(cost))]]]


def _prefixes(docs: DataFrame, codes: np.ndarray, size: int, num: int, den: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            keep, n, tokens = [], [], []
            for row, u in enumerate(sets(batch.column("octets"), size)):
                if len(u):
                    keep.append(row)
                    n.append(len(u))
                    tokens.append(prefix(u, known, num, den).view(np.int64))
            if keep:
                ends = np.cumsum([0, *map(len, tokens)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(tokens)))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(keep)), pa.array(n, pa.int64()), lists], ["id", "n", "tokens"])

    return docs.mapInArrow(run, "id long, n long, tokens array<long>")


def _similar_sizes(n: Column, m: Column, num: int, den: int) -> Column:
    return F.least(n, m) * den >= F.greatest(n, m) * num


def _with_shares(postings: DataFrame) -> DataFrame:
    """Add ``s``, the number of a document's postings in the frame."""
    shares = postings.groupBy(F.col("id").alias("of")).agg(F.count("*").alias("s"))
    return postings.join(shares.hint("merge"), F.col("id") == F.col("of")).drop("of")


def _verify(docs: DataFrame, pairs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose whole texts are similar enough."""

    def similar(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out, last, kept = [], None, None
            runs = sets(left, size)
            for x, y in zip(runs, right, strict=True):
                if kept is None or y.as_buffer() != last:
                    last = y.as_buffer()
                    kept = next(sets(pa.array([y.as_py()], pa.binary()), size))
                common = len(np.intersect1d(x, kept, assume_unique=True))
                out.append(den * common >= num * (len(x) + len(kept) - common))
            yield pa.array(out, pa.bool_())

    similar.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    # both sides grow with the corpus, so neither is broadcast at any size
    left, right = (keep_likely(docs, "id", pairs, c).select(F.col("id").alias(c), F.col("octets").alias(f"text_{c}")) for c in ("a", "b"))
    both = pairs.hint("merge").join(left, "a").hint("merge").join(right, "b")
    check = F.arrow_udf(similar, "boolean").asNondeterministic()(F.col("text_a"), F.col("text_b"))
    return both.select("a", "b", check.alias("similar")).where("similar").select("a", "b")


def _sets_of(docs: DataFrame, size: int) -> DataFrame:
    """Frame (id, tokens) of whole sets; ``docs`` has (id, octets) and keeps its other columns."""
    names = [c for c in docs.columns if c != "octets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [u.view(np.int64) for u in sets(batch.column("octets"), size)]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, tokens)]), pa.int32()), pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], lists], [*names, "tokens"])

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in names) + ", tokens array<long>")


def _allowed(n1: Column, n2: Column, num: int, den: int) -> Column:
    """Largest difference (elements of one set only, of both sets together) of two similar sets of these sizes."""
    return n1 + n2 - 2 * F.ceil(F.lit(num) * (n1 + n2) / F.lit(num + den) - F.lit(1e-9))


def _by_differences(members: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) that join the components of similar members of one group; ``members`` has (grp, c, id, tokens), c the component so far."""
    members = members.withColumn("n", F.size("tokens").cast("long"))
    # half a group's size goes with its members, so that its elements are counted wherever they are; only the common ones meet in one task
    half = members.groupBy(F.col("grp").alias("of")).agg((F.count("*") / 2).alias("half"))
    had = members.hint("merge").join(half, F.col("grp") == F.col("of")).select("grp", "half", F.explode("tokens").alias("token"))
    common = had.groupBy("grp", "token").agg(F.count("*").alias("times"), F.first("half").alias("half")).where("times > half")
    common = common.groupBy(F.col("grp").alias("of")).agg(F.collect_list("token").alias("common"))  # fewer than twice a set's elements
    told = members.join(common.hint("merge"), F.col("grp") == F.col("of"), "left").withColumn("common", F.coalesce("common", F.array().cast("array<long>")))
    own = F.concat(F.array_except("tokens", "common"), F.array_except("common", "tokens"))
    told = told.select("grp", "c", "id", "n", own.alias("own")).withColumn("d", F.size("own").cast("long"))
    told = cut_lineage(told.withColumn("key", F.xxhash64("n", "own")), "differences")  # rows of one id may have different texts

    # rarest differences first; a member shares at least d - most of them with any similar member that is not surely similar
    listed = told.select("grp", "c", "id", "key", "n", "d", F.explode("own").alias("token"))
    times = listed.groupBy(F.col("grp").alias("g"), F.col("token").alias("t")).agg(F.count("*").alias("times"), F.min("c").alias("low"), F.max("c").alias("high"))
    weighed = listed.hint("merge").join(times, (F.col("grp") == F.col("g")) & (F.col("token") == F.col("t")))
    most = F.floor(F.col("n") * F.lit(den - num) / F.lit(num) + F.lit(1e-9))
    length = F.col("d") - F.greatest(F.lit(1), F.col("d") - most) + 1
    rare = F.transform(F.array_sort(F.collect_list(F.struct("times", "token", "low", "high"))), lambda x: F.struct(x["token"], x["low"], x["high"]))
    sides = weighed.groupBy("grp", "c", "id", "key", "n", "d").agg(rare.alias("rare")).select("grp", "c", "id", "key", "n", "d", F.posexplode(F.slice("rare", 1, length.cast("int"))).alias("at", "x"))
    sides = cut_lineage(sides.where("x.low < x.high").select("grp", F.col("x.token").alias("token"), "at", "c", "id", "key", "n", "d"), "difference-postings")
    fields = ("at", "c", "id", "key", "n", "d")
    x, y = (sides.select(F.col("grp").alias(f"grp{i}"), F.col("token").alias(f"token{i}"), *[F.col(f).alias(f"{f}{i}") for f in fields]) for i in (1, 2))
    shared = F.ceil((F.col("d1") + F.col("d2") - _allowed(F.col("n1"), F.col("n2"), num, den)) / 2)
    early = (shared >= 1) & (F.col("at1") <= F.col("d1") - shared) & (F.col("at2") <= F.col("d2") - shared)
    apart = (F.col("id1") > F.col("id2")) & (F.col("c1") != F.col("c2")) & _similar_sizes(F.col("n1"), F.col("n2"), num, den)
    met = x.join(y.hint("merge"), (F.col("grp1") == F.col("grp2")) & (F.col("token1") == F.col("token2")) & apart & early)
    pairs = cut_lineage(met.select("id1", "key1", "id2", "key2", shared.alias("shared")).distinct(), "difference-pairs")
    for i in (1, 2):
        pairs = pairs.hint("merge").join(told.select(*[F.col(c).alias(f"{c}{i}") for c in ("id", "key", "own")]).distinct(), [f"id{i}", f"key{i}"])
    linked = pairs.where(F.size(F.array_intersect("own1", "own2")) >= F.col("shared")).select(F.col("id1").alias("a"), F.col("id2").alias("b"))

    # surely similar: those with the fewest differences stand for all members of their component and size
    nearest = told.groupBy(F.col("grp").alias("g"), F.col("c").alias("c2"), F.col("n").alias("n2")).agg(F.min(F.struct("d", "id")).alias("m"))
    nearest = nearest.select("g", "c2", "n2", F.col("m.d").alias("d2"), F.col("m.id").alias("id2")).where(F.col("d2") <= F.floor(F.col("n2") * F.lit(den - num) / F.lit(num) + F.lit(1e-9)))
    sure = (F.col("d") + F.col("d2") <= _allowed(F.col("n"), F.col("n2"), num, den)) & _similar_sizes(F.col("n"), F.col("n2"), num, den)
    near = told.join(nearest.hint("merge"), (F.col("grp") == F.col("g")) & (F.col("c") != F.col("c2")) & sure)
    return linked.unionByName(near.select(F.col("id").alias("a"), F.col("id2").alias("b")))


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """Frame (doc_id, n_shingles, component_id), one row per document row; ids must be whole numbers.

    Documents link when ``den * intersection >= num * union`` of their sets of ``size``-word shingles; ``component_id`` is the smallest id
    reachable by links, a document's own included.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), octets(F.col(text)).alias("octets"))
    summary = cut_lineage(_summarise(rows, size), "sets")
    members = summary.where("part is null").select("id", "n", "hi", "lo")
    classes = members.where("n > 0").groupBy("n", "hi", "lo").agg(F.min("id").alias("class"))
    codes = _frequencies(summary)

    chosen = classes.where("class is not null").select("class")
    prefixes = cut_lineage(_prefixes(rows, codes, size, num, den).join(chosen.hint("merge"), F.col("id") == F.col("class"), "left_semi"), "prefixes")
    postings = prefixes.select("id", "n", F.size("tokens").cast("long").alias("p"), F.posexplode("tokens").alias("at", "token"))
    lists = postings.groupBy(F.col("token").alias("t")).agg(F.count("*").alias("length")).where("length > 1").select("t")
    shared = cut_lineage(postings.join(lists.hint("merge"), F.col("token") == F.col("t")).drop("t"), "postings")

    # one candidate each: of every list the document with most shared elements, which stands nearest to all others
    weighed = cut_lineage(_with_shares(shared), "weighed-postings")
    hubs = weighed.groupBy(F.col("token").alias("t")).agg(F.max(F.struct("s", (-F.col("id")).alias("back"), F.col("n").alias("hub_n"))).alias("h"))
    hubs = hubs.select("t", (-F.col("h.back")).alias("hub"), "h.hub_n")
    near = weighed.join(hubs.hint("merge"), F.col("token") == F.col("t")).where((F.col("id") != F.col("hub")) & _similar_sizes(F.col("n"), F.col("hub_n"), num, den))
    counted = near.groupBy(F.col("id").alias("a"), F.col("hub").alias("b")).count()
    first = cut_lineage(counted.groupBy("a").agg(F.max_by("b", F.struct("count", -F.col("b"))).alias("b")), "first-pairs")
    edges = cut_lineage(_verify(rows, first, size, num, den), "first-edges")
    found = cut_lineage(components(edges), "components")

    # crowds that stay apart from their hub, by their differences
    grouped = first.select(F.col("a").alias("id"), F.col("b").alias("grp"))
    hubs = first.select(F.col("b").alias("id"), F.col("b").alias("grp")).distinct()
    grouped = hubs.unionByName(grouped.join(hubs.select(F.col("id").alias("h")), F.col("id") == F.col("h"), "left_anti"))
    grouped = grouped.join(found, F.col("id") == F.col("node"), "left").select("id", "grp", F.coalesce("component", "id").alias("c"))
    home = grouped.where("id = grp").select(F.col("grp").alias("g"), F.col("c").alias("home"))
    away = grouped.join(home.hint("merge"), F.col("grp") == F.col("g")).where("c <> home").groupBy(F.col("grp").alias("g")).agg(F.count("*").alias("away"))
    crowds = cut_lineage(grouped.join(away.where(F.col("away") >= CROWD).hint("merge"), F.col("grp") == F.col("g")).select("id", "grp", "c"), "crowds")
    theirs = keep_likely(rows, "id", crowds, "id").withColumnRenamed("id", "of").join(crowds.hint("merge"), F.col("of") == F.col("id"))
    theirs = _sets_of(theirs.select("grp", "c", "id", "octets"), size).join(chosen.hint("merge"), F.col("id") == F.col("class"), "left_semi")
    across = cut_lineage(_by_differences(cut_lineage(theirs, "crowd-sets"), num, den), "crowd-edges")
    if not across.isEmpty():
        edges = cut_lineage(edges.unionByName(across), "all-edges")
        found = cut_lineage(components(edges), "components")

    # all candidates between components and not in one crowd
    placed = shared.join(found, F.col("id") == F.col("node"), "left")
    placed = placed.select("token", "at", "id", "n", "p", F.coalesce("component", "id").alias("c"))
    crowd = crowds.select(F.col("id").alias("member"), "grp")
    placed = placed.join(crowd.hint("merge"), F.col("id") == F.col("member"), "left").drop("member")
    place = F.xxhash64(F.coalesce("grp", "c"), F.col("grp").isNull())  # pairs of one crowd or component are settled
    mixed = placed.groupBy("token").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high").select(F.col("token").alias("t"))
    open_lists = cut_lineage(placed.join(mixed.hint("merge"), F.col("token") == F.col("t"), "left_semi"), "open-postings")
    # elements of a document in open lists: no pair shares more, so most pairs are ruled out before they are formed
    counted = cut_lineage(_with_shares(open_lists), "counted-postings")
    fields = ("at", "id", "n", "p", "c", "grp", "s")
    x = counted.select("token", *[F.col(c).alias(f"{c}1") for c in fields])
    y = counted.select(F.col("token").alias("token2"), *[F.col(c).alias(f"{c}2") for c in fields])
    together = F.ceil(F.lit(num) * (F.col("n1") + F.col("n2")) / F.lit(num + den) - F.lit(1e-9))
    needed = together - F.greatest(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2"))
    apart = (F.col("id1") > F.col("id2")) & (F.col("c1") != F.col("c2")) & _similar_sizes(F.col("n1"), F.col("n2"), num, den)
    apart = apart & F.coalesce(F.col("grp1") != F.col("grp2"), F.lit(True))
    # the first k shared elements of a pair stand early in both prefixes: only there are pairs formed
    k = F.least(F.lit(EARLY), *[F.col(f"p{i}") - F.col(f"n{i}") + F.ceil(F.col(f"n{i}") * num / den - F.lit(1e-9)) for i in (1, 2)])
    early = (F.col("at1") < F.col("n1") - together + k) & (F.col("at2") < F.col("n2") - together + k)
    meet = x.join(y.hint("merge"), (F.col("token") == F.col("token2")) & apart & (F.least("s1", "s2") >= needed) & early)
    pairs = cut_lineage(meet.groupBy("id1", "id2", "n1", "n2", "p1", "p2").count().where(F.col("count") >= k), "pairs")
    for i in (1, 2):
        held = keep_likely(prefixes, "id", pairs, f"id{i}").select(F.col("id").alias(f"id{i}"), F.col("tokens").alias(f"tokens{i}"))
        pairs = pairs.hint("merge").join(held, f"id{i}")
    candidates = pairs.where(F.size(F.array_intersect("tokens1", "tokens2")) >= needed)
    tried = first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    rest = candidates.select(F.col("id1").alias("a"), F.col("id2").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    rest = cut_lineage(rest, "rest-pairs")
    more = cut_lineage(_verify(rows, rest, size, num, den), "rest-edges")
    if not more.isEmpty():
        found = cut_lineage(components(edges.unionByName(more)), "components")

    named = members.join(classes, ["n", "hi", "lo"], "left").join(found, F.col("class") == F.col("node"), "left")
    return named.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "class", "id").alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Rows of ``docs``, all columns, with one document of each group of near duplicates: the one with the smallest id.

    Of rows that repeat an id one stays. Rows with a null id stay: nothing could name them as copies.
    """
    linked = link(docs, doc_id, text, size, num, den).where("doc_id is not null")
    key, ident, count, stays, row = (free_name(docs.columns, f"_jaccard_{c}") for c in ("key", "id", "rows", "stays", "row"))
    named = linked.groupBy(F.col("doc_id").alias(ident)).agg(F.count("*").alias(count), F.bool_or(F.col("doc_id") == F.col("component_id")).alias(stays))
    # few rows: those that go, and those that repeat an id; the others need no join
    special = cut_lineage(named.where((F.col(count) > 1) | ~F.col(stays)), "copies")
    doubtful, plain = split_likely(docs.withColumn(key, F.col(doc_id).cast("long")), key, special, ident)
    same = F.col(key) == F.col(ident)
    order = W.partitionBy(key).orderBy(F.xxhash64(text), F.length(text))
    known = doubtful.join(special.where(stays).hint("merge"), same).withColumn(row, F.row_number().over(order))
    others = doubtful.join(special.hint("merge"), same, "left_anti")
    return plain.select(*docs.columns).unionByName(others.select(*docs.columns)).unionByName(known.where(F.col(row) == 1).select(*docs.columns))
