"""Words of whole texts: column expressions, and NumPy helpers for code that runs inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A run of anything but ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
#: A run of lower-case ASCII letters, digits and code points beyond ASCII.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Bytes handled at a time; a single longer word is still taken whole.
PIECE = 1 << 18


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


#: Rows in an Arrow batch of texts, instead of Spark's default.
BATCH_ROWS = 1_000


def octets(text: Column) -> Column:
    """UTF-8 bytes of a text, empty for null: what the Arrow functions below take.

    Texts are long rows: a session that has Spark's default batch size gets a smaller one, so that the buffers on both sides stay small.
    """
    spark, setting = SparkSession.getActiveSession(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark is not None and spark.conf.get(setting) == "10000":
        spark.conf.set(setting, str(BATCH_ROWS))
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def free_name(columns: Iterable[str], wanted: str) -> str:
    """A column name like ``wanted`` that none of ``columns`` has, whatever its case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def fold_id(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def _table(plain: bool) -> bytes:
    """Byte map that lowers A-Z and turns every separator into a space."""
    table = bytearray(range(256))
    for upper, lower in zip(UPPER.encode(), LOWER.encode(), strict=True):
        table[upper] = lower
    for code in range(0x80):
        character = chr(table[code])
        if (plain and not (character.isdigit() or "a" <= character <= "z")) or (not plain and code in b" \t\n\x0b\x0c\r"):
            table[code] = 0x20
    return bytes(table)


#: For ``bytes.translate`` and, as arrays, for lookups: words of the two kinds above.
SPACED, PLAIN = _table(False), _table(True)

_random = np.random.default_rng(20_240_101)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``size`` of each."""
    if not _powers or len(_powers[0]) < size:
        most = max(size, PIECE + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers[:] = [
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(most - 1, b, np.uint64)]) for b in (np.uint64(_BASE), np.uint64(inverse))
            ]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Words:
    """Words of the rows ``first`` to ``first + len(bounds) - 1`` (exclusive) of an array, one entry per word."""

    first: int
    bounds: np.ndarray  # word index at which each row begins, and the end
    hashes: np.ndarray
    starts: np.ndarray  # byte offsets in the array's buffer
    ends: np.ndarray


def buffer_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary array without nulls, and where its rows begin and end."""
    large = pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int64 if large else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), ends


def _words(data: np.ndarray, at: int, breaks: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in one piece; no word runs over a break."""
    x = table[data]
    inside = x != 0x20
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = breaks[(breaks > 0) & (breaks < len(x))]
    first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _power_tables(len(x))
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(_BYTE[x] * power[: len(x)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts] if len(starts) else np.zeros(0, np.uint64)
    return starts + at, ends + at, mix(hashes + (ends - starts).astype(np.uint64))


def _pieces(data: np.ndarray, begin: int, end: int, table: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut one long row at separators."""
    while end - begin > PIECE:
        cut = begin + PIECE
        while cut < end:
            window = data[begin if cut == begin + PIECE else cut - PIECE : cut]
            gaps = np.flatnonzero(table[window] == 0x20)
            if len(gaps):
                cut = cut - len(window) + int(gaps[-1]) + 1
                break
            cut += PIECE
        cut = min(cut, end)
        yield begin, cut
        begin = cut
    if begin < end:
        yield begin, end


def words(array: pa.Array, plain: bool) -> Iterator[Words]:
    """Words of each row, some rows at a time, in memory bounded by the piece size or the longest row's words."""
    table = np.frombuffer(PLAIN if plain else SPACED, np.uint8)
    data, offsets = buffer_of(array)
    row, rows = 0, len(offsets) - 1
    with np.errstate(over="ignore"):
        while row < rows:
            upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
            begin, end = int(offsets[row]), int(offsets[upto])
            if end - begin <= PIECE:
                starts, ends, hashes = _words(data[begin:end], begin, offsets[row:upto] - begin, table)
                bounds = np.searchsorted(starts, offsets[row : upto + 1])
            else:
                parts = [_words(data[a:b], a, np.zeros(0, np.int64), table) for a, b in _pieces(data, begin, end, table)]
                starts, ends, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
                bounds = np.array([0, len(starts)])
            yield Words(row, bounds, hashes, starts, ends)
            row = upto


def sequences(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive entries; run i begins at entry i."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, size, np.uint64)
        for k in range(size):
            total += h[k : k + n] * _STEP[k]
        return mix(total)
