"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

Word classes are given per byte, so a class may name ASCII characters and "all others" only.
Every word has a 64-bit polynomial hash; equal words have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from newsmart.llm.tables import worker_state

#: Bytes handled in one vector step; bounds temporary memory for texts of any length.
SLICE = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_ALL = np.arange(256)
_UPPER = (_ALL >= 0x41) & (_ALL <= 0x5A)
#: Byte values with A-Z in lower case.
LOWER = np.where(_UPPER, _ALL + 32, _ALL).astype(np.uint8)
#: Word bytes of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | _UPPER | (_ALL >= 0x80)


@dataclass
class Texts:
    """UTF-8 bytes of consecutive texts; text ``i`` is ``data[bounds[i]:bounds[i + 1]]``. NULL reads as empty."""

    data: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, column: pa.Array | pa.ChunkedArray) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        if len(bounds) == 0:
            bounds = np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return cls(raw[bounds[0] : bounds[-1]], bounds - bounds[0])

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def one(self, i: int) -> np.ndarray:
        return self.data[self.bounds[i] : self.bounds[i + 1]]

    def pieces(self, limit: int) -> Iterator[tuple[int, Texts]]:
        """Runs of whole texts of at most ``limit`` bytes (or one longer text), with the first one's number."""
        first, total = 0, len(self)
        while first < total:
            last = int(np.searchsorted(self.bounds, self.bounds[first] + limit, "right")) - 1
            last = min(max(last, first + 1), total)
            cut = self.bounds[first : last + 1]
            yield first, Texts(self.data[cut[0] : cut[-1]], cut - cut[0])
            first = last


def powers(base: np.uint64, count: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``count``."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit keys (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of several texts in order; those of text ``i`` are ``bounds[i]:bounds[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def words(texts: Texts, word_bytes: np.ndarray, values: np.ndarray = LOWER) -> Words:
    """Maximal runs of bytes for which ``word_bytes`` holds; they never cross texts."""
    with np.errstate(over="ignore"):
        return _words(texts, word_bytes, values)


def _words(texts: Texts, word_bytes: np.ndarray, values: np.ndarray) -> Words:
    up, down = worker_state("arrays", "powers", lambda: (powers(BASE, SLICE + 1), powers(INVERSE, SLICE + 1)))
    size = len(texts.data)
    opens = np.zeros(size + 1, bool)
    opens[texts.bounds] = True
    value = (values.astype(np.uint64) + np.uint64(1)) * word_bytes
    starts, ends, at_start, at_end = [], [], [], []
    carry, scale_up, scale_down, inside = np.uint64(0), np.uint64(1), np.uint64(1), False
    for low in range(0, size, SLICE):
        part = texts.data[low : low + SLICE]
        n = len(part)
        mask = word_bytes[part]
        before = np.empty(n, bool)
        before[0], before[1:] = inside, mask[:-1]
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(value[part] * up[:n], out=sums[1:])
        sums *= scale_up
        sums += carry
        fresh = opens[low : low + n]
        s = np.flatnonzero(mask & (~before | fresh))
        e = np.flatnonzero(before & (~mask | fresh))
        starts.append(s + low)
        ends.append(e + low)
        at_start.append((sums[s], down[s] * scale_down))
        at_end.append(sums[e])
        inside, carry = bool(mask[-1]), sums[n]
        scale_up, scale_down = scale_up * up[n], scale_down * down[n]
    if inside:
        ends.append(np.array([size]))
        at_end.append(np.array([carry], np.uint64))
    if not starts:
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(texts.bounds), np.int64))
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    total = np.concatenate(at_end) - np.concatenate([a for a, _ in at_start])
    hashes = mix(total * np.concatenate([b for _, b in at_start]))
    return Words(starts, ends, hashes, np.searchsorted(starts, texts.bounds))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` consecutive hashes."""
    n = max(len(hashes) - length + 1, 0)
    out = np.full(n, np.uint64(length))
    for i in range(length):
        out = mix(out * BASE + hashes[i : i + n])
    return out
