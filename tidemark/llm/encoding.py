"""Token ids of whole texts, each distinct piece of text encoded once.

A tokenizer of the supported kinds first cuts a text into words and then encodes word by word, so a
text may be split wherever its own word cutting must split it and the ids of the parts, put together,
are the ids of the whole. Texts are split there, equal pieces are encoded once per worker, and the
ids of a text are gathered from those of its pieces.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at a time. A longer text spans several windows, cut at safe places. A worker
# keeps a few hundred MB at most by these two bounds.
WINDOW_BYTES = 4_000_000
# Distinct pieces a worker remembers, and ids of them; beyond either it starts anew. A window brings over 100,000
# pieces, so fewer would be forgotten before they come again.
KNOWN_PIECES = 600_000
KNOWN_IDS = 6_000_000
# New pieces encoded at a time: what the tokenizer returns for one is many times larger than its ids.
NEW_PIECES = 4096

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[0x21:0x7F] = True
# ASCII marks that end a word. "|" stands inside the special tokens of the supported files.
_MARK = _GRAPHIC & ~_LETTER
_MARK[48:58] = False
_MARK[ord("|")] = False


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the offsets of each; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_groups(column: pa.Array, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a column in groups of about ``limit`` bytes: first row, bytes, offsets.

    A longer text is a group of its own. Only one group's bytes are held at a time.
    """
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    row, before = 0, 0
    while row < len(column):
        end = max(int(np.searchsorted(ends, before + limit, "right")), row + 1)
        yield row, *text_bytes(column.slice(row, end - row))
        row, before = end, int(ends[end - 1])


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Places where any supported tokenizer splits words, whatever stands around.

    These are: an ASCII blank after a character that is certainly no blank, and an ASCII mark
    after an ASCII letter. A character of two or more bytes is told from the Unicode blanks by its
    first byte; where that is open, no cut is made.
    """
    here, before = data[1:], data[:-1]
    blank = _SPACE[here]
    graphic = _GRAPHIC[before]
    cut = (blank & graphic) | (_MARK[here] & _LETTER[before])
    wide = np.flatnonzero(blank & (before >= 0x80)) + 1
    two = data[np.maximum(wide - 2, 0)]
    three = data[np.maximum(wide - 3, 0)]
    certain = ((two >= 0xC3) & (two <= 0xDF)) | (
        (two >= 0x80) & (two < 0xC0) & (three >= 0xE4) & (three <= 0xF4)
    )
    places = np.flatnonzero(cut) + 1
    return np.sort(np.concatenate([places, wide[certain]])) if certain.any() else places


class PieceEncoder:
    """Encodes the texts of a batch; remembers the ids of pieces seen before."""

    def __init__(self, path: str):
        os.environ["RAYON_NUM_THREADS"] = "1"
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.filled = 0

    def _slots(self, pieces: np.ndarray) -> np.ndarray:
        """Where the ids of each distinct piece are kept, after encoding those not seen yet."""
        if len(self.known) > KNOWN_PIECES or self.filled > KNOWN_IDS:
            self._forget()
        known = self.known
        slots = np.fromiter((known.get(p, -1) for p in pieces), np.int64, len(pieces))
        missing = np.flatnonzero(slots < 0)
        if not len(missing):
            return slots
        first = len(known)
        slots[missing] = np.arange(first, first + len(missing))
        for at in range(0, len(missing), NEW_PIECES):
            self._learn(pieces[missing[at : at + NEW_PIECES]].tolist())
        return slots

    def _learn(self, new: list[str]) -> None:
        """Encode pieces not seen yet and keep their ids."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        first, total = len(self.known), int(lengths.sum())
        self.known.update(zip(new, range(first, first + len(new)), strict=True))
        self.flat = _grown(self.flat, self.filled + total)
        self.starts = _grown(self.starts, first + len(new))
        self.lengths = _grown(self.lengths, first + len(new))
        self.flat[self.filled : self.filled + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.starts[first : first + len(new)] = self.filled + np.cumsum(lengths) - lengths
        self.lengths[first : first + len(new)] = lengths
        self.filled += total

    def _windows(
        self, data: np.ndarray, offsets: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Start of each piece and the slot of its ids, window by window."""
        done = 0
        while done < len(data):
            end = min(done + WINDOW_BYTES, len(data))
            part = data[done:end]
            marks = np.zeros(len(part) + 1, bool)
            marks[safe_cuts(part)] = True
            inside = offsets[np.searchsorted(offsets, done) : np.searchsorted(offsets, end, "right")]
            marks[inside - done] = True
            marks[0] = True
            cuts = np.flatnonzero(marks)
            if end == len(data) or cuts[-1] == len(part):
                cuts = cuts if cuts[-1] == len(part) else np.append(cuts, len(part))
            elif len(cuts) == 1:  # one piece fills the window: take it whole
                end = _next_cut(data, offsets, done)
                part, cuts = data[done:end], np.array([0, end - done])
            pieces = pa.LargeStringArray.from_buffers(
                len(cuts) - 1, pa.py_buffer(np.ascontiguousarray(cuts)), pa.py_buffer(part)
            ).dictionary_encode()
            words = pieces.dictionary.to_numpy(zero_copy_only=False)
            slots = self._slots(words)[pieces.indices.to_numpy()]
            yield done + cuts[:-1], slots
            done += int(cuts[-1])

    def lengths_of(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of ids of each text."""
        totals = np.zeros(len(offsets) - 1, np.int64)
        for starts, slots in self._windows(data, offsets):
            owner = np.searchsorted(offsets, starts, "right") - 1
            first, last = owner[0], owner[-1] + 1
            totals[first:last] += np.bincount(owner - first, self.lengths[slots]).astype(np.int64)
        return totals

    def ids_of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the number of each."""
        totals = np.zeros(len(offsets) - 1, np.int64)
        parts = []
        for starts, slots in self._windows(data, offsets):
            owner = np.searchsorted(offsets, starts, "right") - 1
            first, last = owner[0], owner[-1] + 1
            lengths = self.lengths[slots]
            totals[first:last] += np.bincount(owner - first, lengths).astype(np.int64)
            ends = np.cumsum(lengths)
            at = np.repeat(self.starts[slots] - (ends - lengths), lengths)
            at += np.arange(len(at))
            parts.append(self.flat[at])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), totals


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.resize(array, max(size, 2 * len(array)))


def _next_cut(data: np.ndarray, offsets: np.ndarray, start: int) -> int:
    """First safe cut or end of a text after ``start``."""
    stop = int(offsets[np.searchsorted(offsets, start, "right")])
    at = start
    while at < stop:
        part = data[at : min(at + WINDOW_BYTES, stop)]
        cuts = safe_cuts(part) if at == start else safe_cuts(data[max(at - 4, start) : at + len(part)])
        base = at if at == start else max(at - 4, start)
        later = cuts[base + cuts > start]
        if len(later):
            return base + int(later[0])
        at += len(part)
    return stop


def worker_encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker; later tasks of the worker find its pieces again."""
    kept = sys.__dict__.setdefault("_tidemark_encoders", {})
    if path not in kept:
        kept[path] = PieceEncoder(path)
    return kept[path]
