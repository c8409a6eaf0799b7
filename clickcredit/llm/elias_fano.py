"""Elias-Fano sequences and the n-gram trie that is built of them.

All arrays of a trie live in one file. It is opened as a memory map, so the
workers of a machine share its pages and read only what they touch.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import cached_property
from typing import Any

import numpy as np

_U64 = np.uint64
#: Place of the k-th set bit of each byte.
_SELECT8 = np.zeros((256, 8), np.int64)
for _byte in range(256):
    for _k, _bit in enumerate(i for i in range(8) if _byte >> i & 1):
        _SELECT8[_byte, _k] = _bit
_5, _3, _F, _1 = (_U64(int(x * 8, 16)) for x in ("55", "33", "0f", "01"))


def select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the ``k``-th set bit (from 0) of each 64-bit word."""
    x = words - (words >> _U64(1) & _5)
    x = (x & _3) + (x >> _U64(2) & _3)
    upto = (x + (x >> _U64(4)) & _F) * _1
    k = k.astype(_U64)
    byte = np.zeros(len(words), _U64)
    for j in range(8):
        byte += (upto >> _U64(8 * j) & _U64(255)) <= k
    at = byte * _U64(8)
    before = (upto << _U64(8)) >> at & _U64(255)
    return at.astype(np.int64) + _SELECT8[(words >> at & _U64(255)).astype(np.int64),
                                          (k - before).astype(np.int64)]


#: Queries that are looked up together: their arrays fit the processor's cache.
BLOCK = 1 << 13
#: Values of a sequence for each query after which its directories pay: a select costs about as much as unfolding so many.
UNFOLD = 8


def once(find: Callable[..., np.ndarray], keys: np.ndarray) -> np.ndarray:
    """``find`` of each key, asked once for equal keys, in their order, block by block."""
    distinct, where = np.unique(keys, return_inverse=True)
    parts = [find(distinct[lo:lo + BLOCK]) for lo in range(0, len(distinct), BLOCK)]
    return np.concatenate(parts)[where] if parts else np.empty(0, np.int64)


class EliasFano:
    """A monotone sequence of unsigned numbers: low bits packed, high bits in unary with a rank directory.

    A sequence that is asked often unfolds its high bits into directories of all selects, 4 bytes for each bit at most,
    which only the process that asks holds; the file has none of them.
    """

    def __init__(self, low_bits: int, length: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.low_bits, self.length = low_bits, length
        self.low, self.high, self.ranks = low, high, ranks
        self.zeros = np.arange(len(ranks), dtype=np.int64) * 64 - ranks
        self.mask = _U64((1 << low_bits) - 1)
        self.asked = 0

    @staticmethod
    def build(values: np.ndarray) -> tuple[dict[str, int], dict[str, np.ndarray]]:
        """Its numbers and arrays. ``values`` is sorted, as uint64."""
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros(n * low_bits // 64 + 2, _U64)
        at = np.arange(n, dtype=np.int64) * low_bits
        part = values & _U64((1 << low_bits) - 1)
        word, shift = at >> 6, (at & 63).astype(_U64)
        np.bitwise_or.at(low, word, part << shift)
        over = shift + _U64(low_bits) > _U64(64)
        np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U64(64) - shift[over]))
        places = (values >> _U64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-((top >> low_bits) + n + 2) // 64) * 64, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little").view(_U64)
        ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64))).astype(np.uint32)
        return {"low_bits": low_bits, "length": n}, {"low": low, "high": high, "ranks": ranks}

    def _often(self, queries: int) -> bool:
        """Whether the directories pay, with these queries."""
        self.asked += queries
        return self.asked * UNFOLD > self.length

    @cached_property
    def _highs(self) -> np.ndarray:
        """The high part of each value."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        return (ones - np.arange(len(ones))).astype(np.uint32)

    @cached_property
    def _firsts(self) -> np.ndarray:
        """``_first`` of each high part."""
        zeros = np.flatnonzero(np.unpackbits(~self.high.view(np.uint8), bitorder="little"))
        return np.append(np.uint32(0), (zeros - np.arange(len(zeros))).astype(np.uint32))

    def _select(self, before: np.ndarray, words: np.ndarray, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(before, k, side="right") - 1
        return word * 64 + select_in_word(words[word], k - before[word])

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), _U64)
        bit = at * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(_U64)
        low = self.low[word] >> shift
        # a shift by 64 has no meaning, so the next word moves in two steps
        low |= (self.low[word + 1] << _U64(1)) << (_U64(63) - shift)
        return low & self.mask

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at these places."""
        high = (self._highs[at] if self._often(len(at)) else self._select(self.ranks, self.high, at) - at).astype(_U64)
        return high << _U64(self.low_bits) | self._low(at)

    def find(self, targets: np.ndarray) -> np.ndarray:
        """The place of each value, -1 where it is not in the sequence."""
        def places(some: np.ndarray) -> np.ndarray:
            place, equal = self.successor(some)
            return np.where(equal, place, -1)
        return once(places, targets)

    def _first(self, high: np.ndarray) -> np.ndarray:
        """Place of the first value with this high part or a larger one: behind the zero before it."""
        k = high - 1
        at = np.zeros(len(high), np.int64)
        some = np.flatnonzero(k >= 0)
        k = k[some]
        word = np.searchsorted(self.zeros, k, side="right") - 1
        at[some] = word * 64 + select_in_word(~self.high[word], k - self.zeros[word]) - k
        return at

    def successor(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value not below each target (``length``: none), and whether it equals it.

        The values of one high part lie together; among them the low bits are
        searched by halving.
        """
        place = np.full(len(targets), self.length, np.int64)
        equal = np.zeros(len(targets), bool)
        if not self.length:
            return place, equal
        high = targets >> _U64(self.low_bits)
        live = np.flatnonzero(high < _U64(len(self.high) * 64 - self.length - 1))
        high, wanted = high[live].astype(np.int64), targets[live] & self.mask
        if self._often(len(live)):
            lo, end = self._firsts[high].astype(np.int64), self._firsts[high + 1].astype(np.int64)
        else:
            lo, end = self._first(high), self._first(high + 1)
        place[live] = lo
        some = np.flatnonzero(lo < end)
        live, lo, hi, wanted = live[some], lo[some], end[some], wanted[some]
        while len(live):
            middle = (lo + hi) >> 1
            low = self._low(middle)
            below = low < wanted
            # values may repeat, so an equal one is the first of them only if none is left before it
            equal[live[low == wanted]] = True
            lo, hi = np.where(below, middle + 1, lo), np.where(below, hi, middle)
            place[live] = lo
            some = np.flatnonzero(lo < hi)
            live, lo, hi, wanted = live[some], lo[some], hi[some], wanted[some]
        return place, equal


#: Steps of a quantised logarithm to one.
STEPS = 2048


def quantise(values: np.ndarray) -> np.ndarray:
    """Codes of 16 bits: the nearest step. The same value has the same code in every model and shard."""
    return np.clip(np.rint(values * STEPS), -(1 << 15), (1 << 15) - 1).astype(np.int16)


class Level:
    """Children of one level: pointers from the parents, then the children's ids.

    The ids of each parent's children continue where those of the parent
    before ended, so the whole level is one increasing sequence. A child is
    found by the successor of its id relative to that end.
    """

    def __init__(self, pointers: EliasFano, ids: EliasFano):
        self.pointers, self.ids = pointers, ids

    @staticmethod
    def build(parents: np.ndarray, children: np.ndarray, count: int) -> dict[str, tuple]:
        """From the sorted pairs of parent and child; ``count`` parents there are."""
        pointers = np.searchsorted(parents, np.arange(count + 1))
        ends = np.flatnonzero(np.append(parents[1:] != parents[:-1], True)) if len(parents) else np.empty(0, np.int64)
        steps = np.zeros(count, np.int64)
        steps[parents[ends]] = children[ends] + 1
        base = np.cumsum(steps) - steps
        return {"pointers": EliasFano.build(pointers.astype(_U64)),
                "ids": EliasFano.build((base[parents] + children + 1).astype(_U64))}

    def find(self, parents: np.ndarray, children: np.ndarray) -> np.ndarray:
        """The node of each pair, -1 where there is none."""
        return once(lambda keys: self._find(keys >> 32, keys & (1 << 32) - 1), parents << 32 | children)

    def find_wide(self, parents: np.ndarray, children: np.ndarray) -> np.ndarray:
        """``find`` for children of more than 32 bits, block by block."""
        parts = [self._find(parents[lo:lo + BLOCK], children[lo:lo + BLOCK]) for lo in range(0, len(parents), BLOCK)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def _find(self, parents: np.ndarray, children: np.ndarray) -> np.ndarray:
        if not self.ids.length:
            return np.full(len(parents), -1, np.int64)
        first = self.pointers.get(parents).astype(np.int64)
        last = self.pointers.get(parents + 1).astype(np.int64)
        base = np.zeros(len(parents), _U64)
        later = first > 0
        base[later] = self.ids.get(first[later] - 1)
        node, equal = self.ids.successor(base + children.astype(_U64) + _U64(1))
        return np.where(equal & (node < last), node, -1)


def pack_arrays(meta: dict[str, Any], arrays: dict[str, np.ndarray]) -> bytes:
    """One file: a header of JSON, then the arrays, each at a multiple of 64 bytes."""
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = (at, str(a.dtype), len(a))
        at += -(-a.nbytes // 64) * 64
    head = json.dumps({"meta": meta, "arrays": places}).encode()
    head = len(head).to_bytes(8, "little") + head
    head += bytes(-len(head) % 64)
    return head + b"".join(a.tobytes() + bytes(-a.nbytes % 64) for a in arrays.values())


def map_arrays(path: str) -> tuple[dict[str, Any], dict[str, np.ndarray]]:
    """The header and the arrays of such a file, memory-mapped."""
    return view_arrays(np.memmap(path, np.uint8, "r").view(np.ndarray))


def view_arrays(data: np.ndarray) -> tuple[dict[str, Any], dict[str, np.ndarray]]:
    """The header and the arrays of such a file's bytes, uncopied."""
    size = int(data[:8].view("<u8")[0])
    head = json.loads(data[8:8 + size].tobytes())
    first = -(-(8 + size) // 64) * 64
    return head["meta"], {
        name: data[first + at:first + at + n * np.dtype(kind).itemsize].view(kind)
        for name, (at, kind, n) in head["arrays"].items()}
