"""Words of many texts at once, as byte positions and 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidemark.llm.encoding import text_groups

# Texts handled together, in bytes; a longer one is handled alone. A byte takes some 60 in arrays that live
# at once, in each worker of an executor.
GROUP_BYTES = 250_000

_ASCII = np.arange(256, dtype=np.uint8)
LOWER = np.where((_ASCII >= 65) & (_ASCII <= 90), _ASCII + 32, _ASCII).astype(np.uint8)
AS_IS = _ASCII
# What words are made of: anything but ASCII white space, or ASCII digits, letters and all else
# beyond ASCII (after lower-casing).
NOT_BLANK = ~((_ASCII == 32) | ((_ASCII >= 9) & (_ASCII <= 13)))
ALPHANUMERIC = ((_ASCII >= 48) & (_ASCII <= 57)) | ((_ASCII >= 97) & (_ASCII <= 122)) | (_ASCII >= 128)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240613).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


_kept: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64."""
    if base not in _kept or len(_kept[base]) < n:
        _kept[base] = _powers(base, max(n, 1 << 16))
    return _kept[base][:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each pair; equal runs have equal hashes wherever they stand."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(_BASE, n), out=sums[1:])
    found = (sums[ends] - sums[starts]) * powers(_INVERSE, n + 1)[starts]
    return mixed(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of a group of texts: byte range and hash of each, and where each text's words begin."""

    data: np.ndarray  # folded bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # words of text k: bounds[k] to bounds[k + 1]

    def windows(self, size: int) -> np.ndarray:
        """First word of each run of ``size`` words within one text."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(0, np.int64)
        left = np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(n)
        return np.flatnonzero(left >= size)

    def text(self, k: int) -> bytes:
        """Bytes from the first to the last word of text ``k``."""
        a, b = self.bounds[k], self.bounds[k + 1]
        return self.data[self.starts[a] : self.ends[b - 1]].tobytes() if b > a else b""


def words_of(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray, kind: np.ndarray) -> Words:
    """Words of all texts; ``fold`` maps bytes, ``kind`` tells which folded bytes words are made of."""
    data = fold[data] if fold is not AS_IS else data
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data]
    first = inside[1:] & ~inside[:-1]
    last = inside[:-1] & ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    # A text's edge ends one word and begins the next even where no blank stands between.
    first[edges] |= inside[1:][edges]
    last[edges] |= inside[:-1][edges]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    hashes = run_hashes(_BYTE[data], starts, ends)
    bounds = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, hashes, bounds)


def groups(column: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a column in groups of about ``limit`` bytes: first row, bytes, offsets."""
    return text_groups(column, limit)
