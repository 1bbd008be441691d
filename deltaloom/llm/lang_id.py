"""Language identification with bit-sliced Bloom filters over byte n-grams.

Every language has a Bloom filter of its frequent n-grams. The filters are stored bit-sliced: slot *i* holds one bit per language, so
one lookup per hash returns the set of **all** languages that contain an n-gram. A document's n-grams are looked up, the languages'
bits are counted, each count is corrected for the false positives its filter's fill predicts, and the largest corrected share wins.
A text of few n-grams backs off to the shorter ones of its padded words, which the filters hold as well.

Defined results: a null text, or one without a letter, is ``und`` with score 0. A text whose n-grams no language knows gets the language
with most training documents and score 0. Equal shares go to the language with more training documents, then to the smaller name.
Without labelled rows everything is ``und``. Labels that are null teach nothing. Each input row gives one row; repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deltaloom.llm.text import SPACED, buffer_of, octets
from deltaloom.storage import cut_lineage

UNKNOWN = "und"
GRAM = 4
#: A text with fewer n-grams is judged by the n-grams of 2 to 4 bytes of its words, each word between separators.
FEW = 8

_LETTERS = np.frombuffer(SPACED, np.uint8).copy()
_LETTERS[[c for c in range(128) if not chr(_LETTERS[c]).isalpha()]] = 0x20


@dataclass
class Filters:
    """Bit-sliced filters: ``planes[p][slot]`` has the bits of languages 8p to 8p+7, by descending number of training documents."""

    languages: list[str]
    planes: np.ndarray
    false_rate: np.ndarray


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams by start, and which of them count: within one row, with one separator at most."""
    x = _LETTERS[data]
    n = max(0, len(x) - GRAM + 1)
    grams = np.zeros(n, np.uint32)
    gaps = np.zeros(n, np.uint8)
    for k in range(GRAM):
        grams = (grams << np.uint32(8)) | x[k : k + n]
        gaps += x[k : k + n] == 0x20
    good = gaps <= 1
    for cut in offsets[1:-1]:
        good[max(0, cut - GRAM + 1) : cut] = False
    return grams, good


def _short(raw: bytes) -> np.ndarray:
    """Packed n-grams of 2 to ``GRAM`` bytes of a text's words, a separator before and after it, with one separator at most; in order."""
    x = np.frombuffer(b" " + b" ".join(raw.translate(_LETTERS.tobytes()).split()) + b" ", np.uint8)
    found = []
    for size in range(2, GRAM + 1):
        n = max(0, len(x) - size + 1)
        packed, gaps = np.zeros(n, np.uint32), np.zeros(n, np.uint8)
        for k in range(size):
            packed = (packed << np.uint32(8)) | x[k : k + n]
            gaps += x[k : k + n] == 0x20
        found.append(packed[gaps <= 1])  # shorter ones have zero bytes in front, which no text has after the map
    return np.concatenate(found)


def _slots(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two filter positions of each n-gram."""
    shift = np.uint32(32 - bits)
    turned = grams ^ (grams >> np.uint32(15))
    return (turned * np.uint32(0x9E3779B1)) >> shift, ((turned ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B)) >> shift


def _runs(array: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows in runs of about ``most`` bytes: first row, bytes, offsets. A longer row comes in overlapping pieces of its own."""
    data, offsets = buffer_of(array)
    row = 0
    while row < len(offsets) - 1:
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        begin, end = int(offsets[row]), int(offsets[upto])
        if end - begin <= most:
            yield row, data[begin:end], offsets[row : upto + 1] - begin
        else:
            for at in range(begin, end, most):
                piece = data[at : min(end, at + most + GRAM - 1)]
                yield row, piece, np.array([0, len(piece)])
        row = upto


def train(
    labelled: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = 2_000, profile: int = 50_000, bits: int = 20, max_languages: int = 256
) -> Filters:
    """Filters learned from a bounded sample of the distinct labelled texts.

    ``sample_docs``: most texts per language, those with the smallest hashes; a text counts once per language however often it is
    repeated, and languages with fewer texts are used whole. ``profile``: n-grams kept per language, most frequent first, and as many shorter ones. An n-gram enters a language's filter if its rate there is at least
    a twentieth of its highest rate in any language. ``max_languages``: more distinct labels are an error, nothing is left out.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), octets(F.col(text)).alias("octets")).where("lang is not null")
    rows = rows.withColumn("hash", F.shiftrightunsigned(F.xxhash64("octets"), 1))
    texts = rows.groupBy("lang", "hash").agg(F.count("*").alias("n"))
    counts = texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).orderBy(F.desc("n"), "lang").limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} distinct labels in {lang}")
    names = [r["lang"] for r in counts]
    if not names:
        return Filters([], np.zeros((0, 1 << bits), np.uint8), np.zeros(0))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()  # as large as the sample at most
        for batch in batches:
            new = []
            for k, key in enumerate(zip(batch.column("lang").to_pylist(), batch.column("hash").to_pylist(), strict=True)):
                if key not in met:
                    met.add(key)
                    new.append(k)
            yield batch.take(pa.array(new, pa.int64()))

    # a fifth more than asked for by their hashes, one copy of each per task, one of all, then the smallest hashes of each language
    scale = (1 << 63) - 1
    part = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(scale, scale * sample_docs * 6 // (5 * r["texts"])))])
    schema = "lang string, octets binary, hash long"
    near = rows.where(F.col("hash") <= part[F.col("lang")]).mapInArrow(once, schema).repartition("lang", "hash").mapInArrow(once, schema)
    near = cut_lineage(near, "language-sample")
    last = near.groupBy("lang").agg(F.get(F.sort_array(F.collect_list("hash")), F.lit(sample_docs - 1)).alias("last")).collect()
    upto = F.create_map(*[F.lit(v) for r in last for v in (r["lang"], scale if r["last"] is None else r["last"])])
    sample = near.where(F.col("hash") <= upto[F.col("lang")]).select("lang", "octets")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            seen: dict[str, list[np.ndarray]] = {}
            for first, data, offsets in _runs(batch.column("octets")):
                grams, good = _grams(data, offsets)
                for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                    seen.setdefault(langs[first + k], []).append(grams[a:b][good[a:b]])
            for name, text in zip(langs, batch.column("octets"), strict=True):
                short = _short(text.as_py())
                seen.setdefault(name, []).append(short[short < 1 << 8 * (GRAM - 1)])
            for name, parts in seen.items():
                found, times = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(found)), "gram": found.astype(np.int64), "n": times.astype(np.int64)})

    grams = sample.mapInArrow(gather, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rate = F.col("n") / F.sum("n").over(W.partitionBy("lang", "short"))
    kept = (
        grams.withColumn("short", F.col("gram") < 1 << 8 * (GRAM - 1))
        .withColumn("rate", rate)
        .withColumn("top", F.max("rate").over(W.partitionBy("gram")))
        .where(F.col("rate") * 20 >= F.col("top"))
        .withColumn("rank", F.row_number().over(W.partitionBy("lang", "short").orderBy(F.desc("n"), "gram")))
        .where(F.col("rank") <= profile)
        .groupBy("lang")
        .agg(F.collect_list("gram").alias("grams"))
        .collect()  # at most 2 x profile x max_languages integers
    )
    planes = np.zeros((-(-len(names) // 8), 1 << bits), np.uint8)
    for r in kept:
        k = names.index(r["lang"])
        for slots in _slots(np.array(r["grams"], np.uint32), bits):
            planes[k // 8][slots] |= np.uint8(1 << k % 8)
    fill = np.array([np.mean(planes[k // 8] >> np.uint8(k % 8) & np.uint8(1)) for k in range(len(names))])
    return Filters(names, planes, fill**2)


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _hits(filters: Filters, array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: number of n-grams, of those that count (others if it is few), and how many of the latter each language's filter has."""
    bits = filters.planes.shape[1].bit_length() - 1
    total, hits = np.zeros(len(array), np.int64), np.zeros((len(array), 8 * len(filters.planes)), np.int64)
    for first, data, offsets in _runs(array):
        grams, good = _grams(data, offsets)
        one, two = _slots(grams, bits)
        for p, plane in enumerate(filters.planes):
            sets = plane[one] & plane[two]
            for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                found = sets[a:b][good[a:b]]
                if p == 0:
                    total[first + k] += len(found)
                hits[first + k, 8 * p : 8 * p + 8] += np.bincount(found, minlength=256) @ _BITS
    judged = total.copy()
    for row in np.flatnonzero(total < FEW):
        grams = _short(array[int(row)].as_py())
        one, two = _slots(grams, bits)
        judged[row] = len(grams)
        for p, plane in enumerate(filters.planes):
            hits[row, 8 * p : 8 * p + 8] = np.bincount(plane[one] & plane[two], minlength=256) @ _BITS
    return total, judged, hits[:, : len(filters.languages)]


def language(text: Column, filters: Filters, spark) -> Column:
    """Struct (lang_pred, score, n_grams) of a text. ``score`` is the corrected share of n-grams that the language knows.

    ``n_grams`` counts those of full length: fewer than ``FEW`` are no evidence against a text.
    """
    if not filters.languages:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_grams"))
    model = spark.sparkContext.broadcast(filters)  # 2^bits bytes for every 8 languages

    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = model.value
        for batch in batches:
            total, judged, hits = _hits(known, batch)
            share = np.clip((hits / np.maximum(judged, 1)[:, None] - known.false_rate) / np.maximum(1 - known.false_rate, 1e-9), 0, 1)
            best = share.argmax(axis=1)
            yield pa.StructArray.from_arrays(
                [pa.array(np.array(known.languages, object)[best], pa.string()), pa.array(share[np.arange(len(best)), best]), pa.array(total)],
                ["lang_pred", "score", "n_grams"],
            )

    decide.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    found = F.arrow_udf(decide, "lang_pred string, score double, n_grams long").asNondeterministic()(octets(text))
    lettered = F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))
    return F.struct(
        F.when(lettered, found["lang_pred"]).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(lettered, found["score"]).otherwise(F.lit(0.0)).alias("score"),
        found["n_grams"].alias("n_grams"),
    )


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with a struct column ``_language``; a clashing column of that name is replaced."""
    return docs.withColumn("_language", language(F.col(text), filters, docs.sparkSession))
