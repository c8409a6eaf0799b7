"""Words of many texts as arrays: positions and 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import xxhash

#: ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: All of ASCII but letters and digits.
NOT_ALNUM = np.array([i < 0x80 and not chr(i).isalnum() for i in range(256)])

_PIECE = 1 << 20
_BASE = np.uint64(xxhash.xxh64_intdigest("base") | 1)
_BYTES = np.array([xxhash.xxh64_intdigest(bytes([i])) for i in range(256)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse, as long as needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps))
        return cls.up[:n], cls.down[:n]


def _pieces(buf: np.ndarray, separator: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about a megabyte that end at a separator or at the end."""
    lo, n = 0, len(buf)
    while lo < n:
        hi = min(lo + _PIECE, n)
        while hi < n:
            ends = np.flatnonzero(separator[buf[max(lo, hi - _PIECE):hi]])
            if len(ends):
                hi = max(lo, hi - _PIECE) + int(ends[-1]) + 1
                break
            hi = min(hi + _PIECE, n)
        yield lo, hi
        lo = hi


def word_hashes(data: bytes, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """``starts, hashes`` of the words of ``data``: maximal runs of bytes that separate nothing.

    The hash is polynomial over a prefix sum, then mixed with the length.
    """
    buf = np.frombuffer(data, np.uint8)
    starts, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for lo, hi in _pieces(buf, separator):
        piece = buf[lo:hi]
        inside = np.zeros(len(piece) + 2, np.int8)
        inside[1:-1] = ~separator[piece]
        edges = np.diff(inside)
        a, b = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        up, down = _Powers.get(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTES[piece] * up[:-1], out=sums[1:])
        starts.append(a + lo)
        hashes.append(mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)))
    return np.concatenate(starts), np.concatenate(hashes)


def word_prefixes(data: bytes, lengths: tuple[int, ...], separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """``starts, hashes`` of the words of ``data`` and of their first bytes.

    ``hashes`` has a column for whole words and one for each of ``lengths``: the
    hash of so many bytes, 0 where the word has no more.
    """
    buf = np.frombuffer(data, np.uint8)
    starts, hashes = [np.empty(0, np.int64)], [np.empty((0, 1 + len(lengths)), np.uint64)]
    for lo, hi in _pieces(buf, separator):
        piece = buf[lo:hi]
        inside = np.zeros(len(piece) + 2, np.int8)
        inside[1:-1] = ~separator[piece]
        edges = np.diff(inside)
        a, b = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        up, down = _Powers.get(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTES[piece] * up[:-1], out=sums[1:])
        found = np.zeros((len(a), 1 + len(lengths)), np.uint64)
        found[:, 0] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        for k, n in enumerate(lengths, 1):
            longer = np.flatnonzero(b - a > n)
            at = a[longer]
            # a prefix isn't the word of the same letters
            found[longer, k] = mix((sums[at + n] - sums[at]) * down[at] + np.uint64(n)) ^ np.uint64(1)
        starts.append(a + lo)
        hashes.append(found)
    return np.concatenate(starts), np.concatenate(hashes)


def text_words(texts: list[bytes], separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """``hashes, bounds``: text ``i`` has the word hashes ``hashes[bounds[i]:bounds[i + 1]]``."""
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, hashes = word_hashes(b"\n".join(texts), separator)
    return hashes, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; run ``i`` starts at word ``i``."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = mix(total + hashes[k:k + count])
    return total


def parts_of(sizes: list[int], most: int) -> Iterator[slice]:
    """Runs of consecutive items whose sizes sum to ``most`` or less, one item at least."""
    lo, total = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > most:
            yield slice(lo, i)
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield slice(lo, len(sizes))


@dataclass
class HashArray:
    """Sorted 64-bit keys with a row of values each, found by their leading bits."""

    keys: np.ndarray
    values: np.ndarray
    shift: int = field(init=False)
    first: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        bits = max(1, len(self.keys).bit_length())
        self.shift = 64 - bits
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(self.shift)
        self.first = np.append(np.searchsorted(self.keys, edges), len(self.keys)).astype(np.int32)

    def find(self, queries: np.ndarray) -> np.ndarray:
        """Index of each query, -1 for unknown ones."""
        cell = (queries >> np.uint64(self.shift)).astype(np.int64)
        at, end = self.first[cell], self.first[cell + 1]
        out = np.full(len(queries), -1, np.int32)
        live = np.flatnonzero(at < end)
        at, end, wanted = at[live], end[live], queries[live]
        while len(live):
            same = self.keys[at] == wanted
            out[live[same]] = at[same]
            more = ~same & (at + 1 < end)
            live, at, end, wanted = live[more], at[more] + 1, end[more], wanted[more]
        return out
