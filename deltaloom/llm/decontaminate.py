"""Benchmark decontamination: word windows of benchmark items against the token windows of every document.

The windows of all items are hashed; the hash set is broadcast in blocks of a fixed number of windows (one block as a rule), and every
document's windows are looked up in it. A hash hit counts only after its words have been compared. Hits become word spans, from which
spans or whole documents are removed.

Defined results: null or empty texts have no words and no hits. An item with fewer words than a window is one window; without words it is
none. Items that share a window all count. An item without an id marks words but is in no list. Each document row gives one row. A column
of ``docs`` that is called ``_hits`` stays; the result's last column then has a longer name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.llm.text import LOWER, PLAIN, PLAIN_WORD, UPPER, free_name, octets, sequences, words
from deltaloom.storage import cut_lineage

WINDOW = 10
#: Windows in one broadcast, and bytes of their words and item ids.
BLOCK, BLOCK_BYTES = 200_000, 32 << 20

HITS = "n_words long, starts array<long>, ends array<long>, from_char array<long>, to_char array<long>, items array<string>"


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: their words joined by spaces, number of words, ids of the items that have them."""
    plain = F.regexp_extract_all(F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER), F.lit(f"({PLAIN_WORD})"), 1)
    rows = benchmark.select(F.col(item).cast("string").alias("item"), plain.alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return (
        rows.select("item", "w", F.explode(starts).alias("at"))
        .select("item", F.slice("w", F.col("at"), size).alias("w"))
        .groupBy(F.array_join("w", " ").alias("phrase"), F.size("w").alias("n"))
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


class Lookup:
    """Hash set of the windows of one block, by window length, with their words for the check."""

    def __init__(self, rows):
        phrases = pa.array([r["phrase"].encode() for r in rows], pa.binary())
        self.by_hash: dict[int, dict[int, list[tuple[bytes, list[str]]]]] = {}
        for part in words(phrases, plain=True):
            for k in range(len(part.bounds) - 1):
                r = rows[part.first + k]
                h = int(sequences(part.hashes[part.bounds[k] : part.bounds[k + 1]], r["n"])[0])
                self.by_hash.setdefault(r["n"], {}).setdefault(h, []).append((r["phrase"].encode(), r["items"]))
        self.sorted = {n: np.sort(np.fromiter(h, np.uint64, len(h))) for n, h in self.by_hash.items()}

    def hits(self, array: pa.Array) -> pa.Array:
        out: list[dict] = []
        for part in words(array, plain=True):
            rows = len(part.bounds) - 1
            spans: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
            items: list[set[str]] = [set() for _ in range(rows)]
            for n, known in self.sorted.items():
                runs = sequences(part.hashes, n)
                if not len(runs):
                    continue
                at = np.searchsorted(known, runs)
                at[at == len(known)] = 0
                for i in np.flatnonzero(known[at] == runs).tolist():
                    row = int(np.searchsorted(part.bounds, i, "right")) - 1
                    if i + n > part.bounds[row + 1]:
                        continue  # runs into the next text
                    raw = memoryview(array[part.first + row].as_buffer())
                    base = int(part.starts[i]) - self._row_begin(array, part.first + row)
                    length = int(part.ends[i + n - 1] - part.starts[i])
                    phrase = b" ".join(bytes(raw[base : base + length]).translate(PLAIN).split())
                    for text, ids in self.by_hash[n][int(runs[i])]:
                        if text == phrase:
                            spans[row].append((i - int(part.bounds[row]), n))
                            items[row].update(ids)
            for row in range(rows):
                out.append(self._row(array, part, row, spans[row], items[row]))
        return pa.array(out, _HIT_TYPE)

    @staticmethod
    def _row_begin(array: pa.Array, row: int) -> int:
        width = np.int64 if pa.types.is_large_binary(array.type) else np.int32
        return int(np.frombuffer(array.buffers()[1], width)[array.offset + row])

    def _row(self, array, part, row: int, spans: list[tuple[int, int]], items: set[str]) -> dict:
        """Spans of one row, joined where they overlap or touch, in words and in characters."""
        merged = _union([(start, start + n) for start, n in spans])
        first, chars = int(part.bounds[row]), []
        if merged:
            raw, base = array[part.first + row].as_py(), self._row_begin(array, part.first + row)
            seen = at = 0
            for a, b in merged:
                pair = []
                for edge in (int(part.starts[first + a]) - base, int(part.ends[first + b - 1]) - base):
                    seen, at = seen + len(raw[at:edge].decode("utf-8", "replace")), edge
                    pair.append(seen)
                chars.append(pair)
        return {
            "n_words": int(part.bounds[row + 1]) - first,
            "starts": [a for a, _ in merged],
            "ends": [b for _, b in merged],
            "from_char": [a for a, _ in chars],
            "to_char": [b for _, b in chars],
            "items": sorted(items),
        }


_HIT_TYPE = pa.struct(
    [("n_words", pa.int64())] + [(n, pa.list_(pa.int64())) for n in ("starts", "ends", "from_char", "to_char")] + [("items", pa.list_(pa.string()))]
)


def _scan(text: Column, rows: list, spark) -> Column:
    known = spark.sparkContext.broadcast(rows)  # at most BLOCK windows

    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup = Lookup(known.value)
        for batch in batches:
            yield lookup.hits(batch)

    look.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(look, HITS).asNondeterministic()(octets(text))


def _union(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Spans in order, joined where they overlap or touch."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


def _both(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Union of the hits that two blocks of windows found in each text. Spans that touch in words are one; so are their characters."""
    for left, right in batches:
        out = []
        for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
            edges = dict(zip(a["starts"] + b["starts"], a["from_char"] + b["from_char"], strict=True))
            ends = dict(zip(a["ends"] + b["ends"], a["to_char"] + b["to_char"], strict=True))
            spans = _union(list(zip(a["starts"] + b["starts"], a["ends"] + b["ends"], strict=True)))
            out.append({
                "n_words": a["n_words"], "starts": [s for s, _ in spans], "ends": [e for _, e in spans],
                "from_char": [edges[s] for s, _ in spans], "to_char": [ends[e] for _, e in spans], "items": sorted({*a["items"], *b["items"]}),
            })
        yield pa.array(out, _HIT_TYPE)


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """All rows and columns of ``docs`` with a last column ``_hits``, a struct: words, hit spans in words and characters, ids of found items."""
    spark = docs.sparkSession
    known = cut_lineage(windows(benchmark, item, "text", size), "windows")
    size_of = F.octet_length("phrase") + F.aggregate("items", F.lit(0), lambda s, i: s + F.octet_length(i))
    count, held = known.agg(F.count("*"), F.coalesce(F.sum(size_of), F.lit(0))).first()
    parts = max(1, -(-count // block), -(-held // BLOCK_BYTES))
    out, hits = docs, free_name(docs.columns, "_hits")
    more = free_name([*docs.columns, hits], "_hits_too")
    for part in range(parts):
        rows = known.where(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == part).collect() if parts > 1 else known.collect()
        column = _scan(F.col(text), rows, spark)
        if part == 0:
            out = out.withColumn(hits, column)
            continue
        out = out.withColumn(more, column).withColumn(hits, F.arrow_udf(_both, HITS).asNondeterministic()(hits, more)).drop(more)
    return out


def hit_words(hits: Column) -> Column:
    """Number of words inside any hit span."""
    return F.aggregate(F.zip_with(hits["starts"], hits["ends"], lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)


def without_spans(text: Column, hits: Column) -> Column:
    """The text with its hit spans cut out."""
    begins = F.concat(F.array(F.lit(0).cast("long")), hits["to_char"])
    ends = F.concat(hits["from_char"], F.array(F.length(text).cast("long")))
    return F.array_join(F.zip_with(begins, ends, lambda a, b: F.substr(text, (a + 1).cast("int"), (b - a).cast("int"))), "")


def remove_documents(scanned: DataFrame, share: float = 0.0) -> DataFrame:
    """Rows whose hit share of words does not exceed ``share``; with 0 every hit document goes."""
    hits = scanned.columns[-1]
    return scanned.where(hit_words(F.col(hits)) <= F.col(hits)["n_words"] * share).drop(hits)


def remove_spans(scanned: DataFrame, text: str = "text") -> DataFrame:
    """All rows, their texts without the hit spans."""
    hits = scanned.columns[-1]
    cut = F.when(F.size(F.col(hits)["starts"]) > 0, without_spans(F.col(text), F.col(hits))).otherwise(F.col(text))
    return scanned.withColumn(text, cut).drop(hits)
