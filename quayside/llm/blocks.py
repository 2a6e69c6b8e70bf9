"""Texts of an Arrow batch as byte blocks: words, lines and hashes without a Python object per word.

A word is a run of bytes outside space and 0x09-0x0D. A span's hash is its polynomial at two points modulo the
prime 2^31 - 1, mixed; unlike one modulo 2^64 it has no texts that collide for every point. Hashes are the
same on every machine and for every batching.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 20
U = np.uint64
_PRIME = (1 << 31) - 1
_POINTS = (0x3243F6A9, 0x5BF0A8B1)  # any two numbers below the prime
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def _is_space(data: np.ndarray) -> np.ndarray:
    """``SPACE`` for each byte, by comparisons, which are faster than looking it up."""
    return (data == 0x20) | (data - np.uint8(9) < 5)


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime, in place: 2^31 is 1 modulo 2^31 - 1, so high bits are added to low ones, without a division."""
    high = np.empty_like(x)
    for _ in range(2):
        np.right_shift(x, U(31), out=high)
        x &= U(_PRIME)
        x += high
    np.subtract(x, U(_PRIME), out=high)  # wraps to a large number where x is below the prime
    return np.minimum(x, high, out=x)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


#: Powers that a worker keeps, for each point; a longer text has its own for as long as it is hashed.
KEPT_POWERS = 1 << 21
_KEPT: dict[int, np.ndarray] = {}


def _powers_of(base: int, bits: int) -> np.ndarray:
    powers = np.ones(1 << bits, np.uint32)
    for i in range(bits):  # each round knows twice as many
        powers[1 << i : 2 << i] = powers[: 1 << i].astype(np.uint64) * U(pow(base, 1 << i, _PRIME)) % U(_PRIME)
    return powers


def _powers(n: int, base: int) -> np.ndarray:
    """The first ``n`` powers; of all tables of a point only the longest is kept."""
    powers = _KEPT.get(base)
    if powers is None or len(powers) < n:
        powers = _powers_of(base, max(16, int(n).bit_length()))
        if len(powers) <= KEPT_POWERS:
            _KEPT[base] = powers
    return powers[:n]


def forget_powers() -> None:
    """For tasks that hash no spans: what a worker's earlier tasks have kept is freed."""
    _KEPT.clear()


class Block:
    """Some whole texts: ``data`` are their bytes, text ``i`` is ``data[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first, self.n = data, bounds, first, len(bounds) - 1
        self._prefix = {}

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """The text number of each byte position."""
        return np.searchsorted(self.bounds, positions, side="right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each span."""
        return mix(self.at_point(0, starts, ends) << U(32) | self.at_point(1, starts, ends))

    def at_point(self, i: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each span's polynomial at one of the two points, below the prime."""
        point = _POINTS[i]
        if i not in self._prefix:
            self._prefix[i] = self._sums(self.data.astype(np.uint64) + U(1), point)
        prefix = self._prefix[i]
        part = _reduced(prefix[ends] - prefix[starts])
        part *= _powers(len(self.data) + 1, pow(point, -1, _PRIME))[starts]
        return _reduced(part)

    def _sums(self, values: np.ndarray, point: int) -> np.ndarray:
        terms = values * _powers(len(values), point)
        if len(terms) > 1 << 24:  # below, the sum of products stays under 2^64
            terms = _reduced(terms)
        out = np.zeros(len(terms) + 1, np.uint64)
        np.cumsum(terms, out=out[1:])
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts and ends of all words; no word crosses a text."""
        return self.runs(_is_space(self.data))

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all ``\\n``-split lines, empty ones and the last one included."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.sort(np.concatenate([self.bounds[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.bounds[1:], breaks]), kind="stable")
        return starts, ends

    def runs(self, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of bytes that are no gap; no run crosses a text."""
        n = len(gap)
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        first, last = ~gap, ~gap
        first[1:] &= gap[:-1] | edge[1:n]
        last[:-1] &= gap[1:] | edge[1:n]
        return np.flatnonzero(first), np.flatnonzero(last) + 1


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string or binary array into blocks; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, len(texts))
        yield Block(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first)
        first = last


def sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` for each owner below ``n``."""
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)
