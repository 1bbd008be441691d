"""Elias-Fano sequences and a two-level n-gram trie in memory-mapped arrays, with vectorised look-ups.

A monotone sequence of n numbers below u is stored as the low log2(u/n) bits of each, packed, and a bit vector in which number i sets bit
(high part + i). A directory of zeros per 64-bit word gives select0, from which the few numbers with one high part are found.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

import numpy as np

_U = np.uint64


def _select_bit(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the set bit number ``rank`` (from 0) in each 64-bit word, by halving."""
    place, words, rank = np.zeros(len(words), np.int64), words.copy(), rank.astype(np.int64).copy()
    for half in (32, 16, 8, 4, 2, 1):
        low = words & _U((1 << half) - 1)
        ones = np.bitwise_count(low).astype(np.int64)
        above = rank >= ones
        rank -= np.where(above, ones, 0)
        place += np.where(above, half, 0)
        words = np.where(above, words >> _U(half), low)
    return place


@dataclass
class EliasFano:
    size: int
    low_bits: int
    low: np.ndarray  # packed
    high: np.ndarray  # bit vector
    zeros: np.ndarray  # zeros before each word of ``high``

    @staticmethod
    def build(values: np.ndarray, universe: int) -> EliasFano:
        """From ascending numbers below ``universe``."""
        n = len(values)
        bits = max(0, (max(1, universe // max(1, n))).bit_length() - 1)
        values = values.astype(_U)
        index = np.arange(n, dtype=np.int64)
        low = np.zeros(n * bits // 64 + 2, _U)
        if bits:
            part, at = values & _U((1 << bits) - 1), index * bits
            offset = (at & 63).astype(_U)
            np.bitwise_or.at(low, at >> 6, part << offset)
            over = offset > _U(64 - bits)
            np.bitwise_or.at(low, (at[over] >> 6) + 1, part[over] >> (_U(64) - offset[over]))
        places = (values >> _U(bits)).astype(np.int64) + index
        words = (n + (universe >> bits) + 2) // 64 + 1
        high = np.zeros(words, _U)
        np.bitwise_or.at(high, places >> 6, _U(1) << (places & 63).astype(_U))
        zeros = np.zeros(words + 1, np.int64)
        np.cumsum(64 - np.bitwise_count(high).astype(np.int64), out=zeros[1:])
        return EliasFano(n, bits, low, high, zeros)

    def _select0(self, rank: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros, rank, "right") - 1
        return word * 64 + _select_bit(~self.high[word], rank - self.zeros[word])

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), _U)
        at = index * self.low_bits
        word, offset = at >> 6, (at & 63).astype(_U)
        upper = np.where(offset > 0, self.low[word + 1] << ((_U(64) - offset) & _U(63)), _U(0))
        return ((self.low[word] >> offset) | upper) & _U((1 << self.low_bits) - 1)

    def get(self, index: np.ndarray) -> np.ndarray:
        """Numbers at the given positions."""
        index = np.asarray(index, np.int64)
        ones = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(ones, index, "right") - 1
        place = word * 64 + _select_bit(self.high[word], index - ones[word])
        return ((place - index).astype(_U) << _U(self.low_bits)) | self._low(index)

    def successor(self, values: np.ndarray, least: np.ndarray | None = None, most: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first number not below each value, and whether it equals it. ``least``/``most`` narrow the search to a node's children."""
        values = values.astype(_U)
        part = (values >> _U(self.low_bits)).astype(np.int64)
        begin = np.where(part > 0, self._select0(np.maximum(part - 1, 0)) - np.maximum(part - 1, 0), 0)
        end = self._select0(part) - part
        if least is not None:
            begin, end = np.maximum(begin, least), np.minimum(end, most)
            begin = np.minimum(begin, end)
        wanted = values & _U((1 << self.low_bits) - 1) if self.low_bits else np.zeros(len(values), _U)
        low, high = begin.copy(), end.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            smaller = np.zeros(len(values), bool)
            smaller[open_] = self._low(middle[open_]) < wanted[open_]
            low, high = np.where(open_ & smaller, middle + 1, low), np.where(open_ & ~smaller, middle, high)
        equal = low < end
        equal[equal] = self._low(low[equal]) == wanted[equal]
        return low, equal


#: Bits of a successor's hash within its context.
SUCCESSOR_BITS = 40
#: Logarithms (base 10) from 0 down to -8 in 254 steps; code 0 is for what is not there.
_STEP = 8 / 254


def quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-np.log10(np.maximum(p, 1e-9)) / _STEP) + 1, 1, 255).astype(np.uint8)


def restore(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (-(codes.astype(np.float64) - 1) * _STEP), 0.0)


class Trie:
    """Contexts and their successors. Level 1: context keys, exact counts, quantised backoff weights, monotone pointers into level 2.
    Level 2: successors relative to their context, quantised discounted probabilities. All arrays are views of one mapped file."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, totals: np.ndarray, owners: np.ndarray, successors: np.ndarray, pair_counts: np.ndarray, prior: float):
        """``keys`` ascending; ``owners`` (positions in ``keys``) and ``successors`` ascending together; probabilities by Dirichlet smoothing."""
        self.base = int(keys[0]) if len(keys) else 0
        roots = EliasFano.build(keys - _U(self.base), int(keys[-1]) - self.base + 1 if len(keys) else 1)
        pointers = EliasFano.build(np.searchsorted(owners, np.arange(len(keys) + 1)), len(owners) + 1)
        children = EliasFano.build(
            (owners.astype(_U) << _U(SUCCESSOR_BITS)) | successors.astype(_U), max(1, len(keys)) << SUCCESSOR_BITS
        )
        backoff = quantise(prior / (totals + prior))
        alpha = quantise(pair_counts / (totals[owners] + prior)) if len(owners) else np.zeros(0, np.uint8)
        self._map([roots, pointers, children], {"counts": counts, "backoff": backoff, "alpha": alpha})

    def _map(self, sequences: list[EliasFano], arrays: dict[str, np.ndarray]) -> None:
        pieces = [a for s in sequences for a in (s.low, s.high, s.zeros)] + list(arrays.values())
        with tempfile.TemporaryFile() as file:
            at = []
            for a in pieces:
                at.append(file.tell())
                file.write(a.tobytes())
                file.write(b"\0" * (-file.tell() % 8))
            file.flush()
            mapped = np.memmap(file, np.uint8, "r")  # outlives the closed, nameless file
        views = [mapped[b : b + a.nbytes].view(a.dtype) for a, b in zip(pieces, at, strict=True)]
        for k, s in enumerate(sequences):
            s.low, s.high, s.zeros = views[3 * k : 3 * k + 3]
        self.roots, self.pointers, self.children = sequences
        self.counts, self.backoff, self.alpha = views[3 * len(sequences) :]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions of context keys, -1 where there is none."""
        if not self.roots.size:
            return np.full(len(keys), -1, np.int64)
        inside = (keys >= _U(self.base)) & (keys - _U(self.base) <= self.roots.get([self.roots.size - 1])[0])
        at, same = self.roots.successor(np.where(inside, keys - _U(self.base), _U(0)))
        return np.where(inside & same, at, -1)

    def probabilities(self, owners: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Codes of successors below given contexts (positions, -1 for none): 0 where the context never had the successor."""
        out = np.zeros(len(owners), np.uint8)
        known = np.flatnonzero(owners >= 0)
        if self.children.size and len(known):
            own = owners[known]
            least, most = self.pointers.get(own).astype(np.int64), self.pointers.get(own + 1).astype(np.int64)
            value = (own.astype(_U) << _U(SUCCESSOR_BITS)) | successors[known].astype(_U)
            at, same = self.children.successor(value, least, most)
            out[known[same]] = self.alpha[at[same]]
        return out
