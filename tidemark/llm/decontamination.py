"""Find benchmark passages in documents.

A prefix-filtered containment join. A window of an item is a set of word positions that must all be
found, so by the prefix principle one word of it is enough to look for: the rarest by its count in
the documents. Words of documents are joined with these rarest words; position and length bound each
candidate to one place that must lie inside the text; hashes and then the words themselves verify it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W
from tidemark.session import stored

WINDOW = 13
# Benchmark words held by a task at once. A larger benchmark is joined in so many parts, each
# broadcast in its turn, all in one pass over the documents' rows.
PART_WORDS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows (words, item_ids as strings) of all items; a shorter item is one window."""
    text = F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER)
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    return (
        items.select(F.col(id_col).cast("string").alias("item"), words.alias("w"))
        .where(F.size("w") > 0)
        .select(
            "item",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1))),
                    lambda at: F.slice("w", at, F.lit(window)),
                )
            ).alias("words"),
        )
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
    )


def word_counts(docs: DataFrame, vocabulary: list[str], text_col: str) -> dict[str, int]:
    """How often each word of a bounded list occurs in all documents."""
    spark = docs.sparkSession
    hashes = _hashes(vocabulary)
    order = np.argsort(hashes)
    table = spark.sparkContext.broadcast(hashes[order])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        totals = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, data, offsets in W.groups(batch.column(0)):
                found = W.words_of(data, offsets, W.LOWER, W.ALPHANUMERIC).hashes
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                totals += np.bincount(at[known[at] == found], minlength=len(known))
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], names=["k", "n"])

    counts = np.zeros(len(vocabulary), np.int64)
    sums = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "k long, n long")
    for row in sums.groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[row["k"]] = row["n"]
    return {vocabulary[k]: int(n) for k, n in zip(order, counts, strict=True)}


def _hashes(vocabulary: list[str]) -> np.ndarray:
    data = [w.encode() for w in vocabulary]
    sizes = np.array([len(w) for w in data], np.int64)
    ends = np.cumsum(sizes)
    joined = np.frombuffer(b"".join(data), np.uint8)
    return W.words_of(joined, np.concatenate([[0], ends]), W.AS_IS, W.ALPHANUMERIC).hashes


class Index:
    """One part of the benchmark: its windows by their rarest word."""

    def __init__(self, windows: list[tuple[list[str], list[str]]], counts: dict[str, int]):
        self.words = [[w.encode() for w in words] for words, _ in windows]
        self.items = [items for _, items in windows]
        sizes = np.array([len(w) for w in self.words], np.int64)
        flat = _hashes([w for words, _ in windows for w in words])
        first = np.cumsum(sizes) - sizes
        rarest = np.array(
            [min(range(len(words)), key=lambda k: (counts[words[k]], words[k], k)) for words, _ in windows], np.int64
        )
        keys = flat[first + rarest]
        self.window = np.argsort(keys, kind="stable")
        self.keys = keys[self.window]
        self.sizes, self.rarest = sizes, rarest
        self.hashes = W.run_hashes(flat, first, first + sizes)

    def find(self, w: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Places where windows stand in the texts: first word and window of each."""
        low = np.searchsorted(self.keys, w.hashes, "left")
        hit = np.flatnonzero(self.keys[np.minimum(low, len(self.keys) - 1)] == w.hashes)
        low = low[hit]
        many = np.searchsorted(self.keys, w.hashes[hit], "right") - low
        ends = np.cumsum(many)
        within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - many, many)
        window = self.window[np.repeat(low, many) + within]
        place = np.repeat(hit, many)
        text = np.searchsorted(w.bounds, place, "right") - 1
        start = place - self.rarest[window]
        end = start + self.sizes[window]
        fits = (start >= w.bounds[text]) & (end <= w.bounds[text + 1])
        start, end, window = start[fits], end[fits], window[fits]
        same = W.run_hashes(w.hashes, start, end) == self.hashes[window] if len(start) else fits[:0]
        start, window = start[same], window[same]
        exact = np.fromiter((self._equal(w, s, k) for s, k in zip(start, window, strict=True)), bool, len(start))
        return start[exact], window[exact]

    def _equal(self, w: W.Words, start: int, window: int) -> bool:
        return all(
            w.data[w.starts[start + j] : w.ends[start + j]].tobytes() == word
            for j, word in enumerate(self.words[window])
        )


def mark_passages(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    part_words: int = PART_WORDS,
) -> DataFrame:
    """``docs`` in a struct ``row`` with n_words, the hit word ranges and the items found.

    ``spans`` are (first, last + 1) of maximal runs of hit words, counted from 0; ``items`` are the
    distinct ids, as strings, of the items with an occurring window, sorted. Words are lower-cased
    runs of ASCII letters, ASCII digits and characters beyond ASCII. Null texts and items without
    words have none; an item without an id marks words and is not listed; repeated items count
    once; every row of ``docs`` gives one row; an empty benchmark marks nothing.
    """
    spark = docs.sparkSession
    windows = stored(item_windows(items, window, item_col, item_text_col), "item-windows")
    total = windows.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = -(-total // part_words)
    frame = docs.select(
        F.struct("*").alias("row"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("marks"),
        F.array().cast("array<string>").alias("items"),
    )
    indexes = []
    for part in range(parts):
        held = [
            (r["words"], r["items"])
            for r in windows.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == part).collect()
        ]
        if held:
            vocabulary = sorted({w for words, _ in held for w in words})
            counts = word_counts(docs, vocabulary, text_col)
            indexes.append(spark.sparkContext.broadcast(Index(held, counts)))
    for index in indexes or [None]:
        frame = frame.mapInArrow(_marker(index, text_col), frame.schema)
    spans = F.expr(
        "transform(sequence(0, size(marks) div 2 - 1),"
        " k -> named_struct('first', get(marks, int(2 * k)), 'end', get(marks, int(2 * k + 1))))"
    )
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    return frame.select(
        "row", "n_words", F.when(F.size("marks") > 0, spans).otherwise(none).alias("spans"), "items"
    )


def _marker(index, text_col: str):
    """Add the hits of one part of the benchmark to what earlier parts found."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = index.value if index is not None else None
        for batch in batches:
            rows = batch.column("row")
            texts = rows.field(text_col).cast(pa.large_string())
            for row, data, offsets in W.groups(texts):
                n = len(offsets) - 1
                w = W.words_of(data, offsets, W.LOWER, W.ALPHANUMERIC)
                start, window = part.find(w) if part else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                old = batch.column("marks").slice(row, n)
                marks, sizes = _merged(w, start, start + part.sizes[window] if part else start, old)
                items = batch.column("items").slice(row, n).to_pylist()
                text = np.searchsorted(w.bounds, start, "right") - 1
                for k, found in {(int(t), int(x)) for t, x in zip(text, window, strict=True)}:
                    items[k] = items[k] + part.items[found]
                for k in set(text.tolist()):
                    items[k] = sorted(set(items[k]))
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.slice(row, n),
                        pa.array(np.diff(w.bounds)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(marks)),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["row", "n_words", "marks", "items"],
                )

    return mark


def _merged(w: W.Words, start: np.ndarray, end: np.ndarray, old: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Borders of the maximal hit runs of each text, from new places and borders found before."""
    base = np.repeat(w.bounds[:-1], old.value_lengths().to_numpy())
    borders = old.flatten().to_numpy() + base
    start = np.concatenate([start, borders[::2]])
    end = np.concatenate([end, borders[1::2]])
    change = np.zeros(len(w.hashes) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    hit = np.zeros(len(w.hashes) + 2, bool)
    hit[1:-1] = np.cumsum(change[:-1]) > 0
    first, last = hit[1:] & ~hit[:-1], hit[:-1] & ~hit[1:]
    edges = w.bounds[:-1][np.diff(w.bounds) > 0]
    first[edges] |= hit[1:][edges]
    last[edges] |= hit[:-1][edges]
    # Every run gives its first word and the word after its last, in turn.
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    text = np.searchsorted(w.bounds, a, "right") - 1
    marks = np.column_stack([a - w.bounds[text], b - w.bounds[text]]).ravel()
    return marks.astype(np.int64), 2 * np.bincount(text, minlength=len(w.bounds) - 1)


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``mark_passages`` with n_hit, n_items and ``contaminated``: a twentieth of the words are hit."""
    marked = mark_passages(docs, items, **options)
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return marked.withColumn("n_hit", hits).withColumns(
        {
            "n_items": F.size("items").cast("long"),
            "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
        }
    )
