"""Remove word runs that an earlier document already has.

The reference of a document is the whole corpus before it, so no automaton of the reference has a
bounded size, and none can be broadcast. Instead the reference is cut into shards that are met only
by the passages that could match in them:

1. Each window of words has an anchor, the least hash of the short word runs inside it. Equal
   windows have equal anchors. Anchors that occur under one document id only are left out.
2. Around each shared anchor, a document gives a passage: the words of the neighbouring windows that
   have this anchor. Equal passages are counted once, with the least document id.
3. The distinct passages of some anchors are a reference shard of bounded size. Its generalised
   suffix automaton knows, for each state, the least document id that has the state's words. The
   same passages are streamed through it, and matching statistics, capped at the window length,
   give the first owner of each window, word for word.
4. A window is removed from each document whose id is greater than the owner's. What overlapping
   windows cover is one maximal span.

An anchor with very many different passages is split by the windows themselves, so that one very
common line is no large group anywhere.
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
# Words of the run that anchors a window.
ANCHOR = 5
# Words of a reference shard; it ends with the anchor that passes this.
SHARD_WORDS = 20_000
# Different passages of an anchor beyond which it is split by windows: what a task can well hold as one
# shard, about 80,000 words. Each passage of it then counts once for each of its windows.
CROWDED = 4000


class SuffixAutomaton:
    """Suffix automaton of several word sequences; each state knows the least owner of its words."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner: list = [None]

    def add(self, words: list, owner) -> None:
        state = 0
        for word in words:
            state = self._extend(state, word, owner)

    def _extend(self, last: int, word, owner) -> int:
        nexts, link, length = self.next, self.link, self.length
        known = nexts[last].get(word)
        if known is not None and length[known] == length[last] + 1:
            if owner < self.owner[known]:
                self.owner[known] = owner
            return known
        made = -1
        if known is None:
            made = self._state({}, length[last] + 1, owner)
            while last >= 0 and word not in nexts[last]:
                nexts[last][word] = made
                last = link[last]
            if last < 0:
                link[made] = 0
                return made
            known = nexts[last][word]
            if length[known] == length[last] + 1:
                link[made] = known
                return made
        copy = self._state(dict(nexts[known]), length[last] + 1, self.owner[known])
        link[copy] = link[known]
        link[known] = copy
        while last >= 0 and nexts[last].get(word) == known:
            nexts[last][word] = copy
            last = link[last]
        if made >= 0:
            link[made] = copy
            return made
        if owner < self.owner[copy]:
            self.owner[copy] = owner
        return copy

    def _state(self, nexts: dict, length: int, owner) -> int:
        self.next.append(nexts)
        self.link.append(0)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.next) - 1

    def close(self) -> None:
        """Hand owners down to the suffixes, longest state first."""
        owner, link = self.owner, self.link
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            parent = link[state]
            if parent > 0 and owner[state] < owner[parent]:
                owner[parent] = owner[state]

    def owners(self, words: list, window: int) -> list:
        """Least owner of each full window of ``words``, None where the window is not in here."""
        nexts, link, length = self.next, self.link, self.length
        found, state, matched = [], 0, 0
        for i, word in enumerate(words):
            while state and word not in nexts[state]:
                state = link[state]
                matched = length[state]
            state = nexts[state].get(word, 0)
            matched = matched + 1 if state else 0
            while state and length[link[state]] >= window:
                state = link[state]
            matched = min(matched, length[state])
            if i >= window - 1:
                found.append(self.owner[state] if matched >= window else None)
        return found


def _anchored(w: W.Words, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows of one text with one anchor: text, anchor, first word, windows."""
    starts = w.windows(window)
    n = len(w.hashes)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    at = np.arange(n - anchor + 1)
    runs = W.run_hashes(w.hashes, at, at + anchor)
    least = runs[: n - window + 1].copy()
    for shift in range(1, window - anchor + 1):
        np.minimum(least, runs[shift : shift + n - window + 1], out=least)
    anchors = least[starts].view(np.int64)
    text = np.searchsorted(w.bounds, starts, "right") - 1
    first = np.ones(len(starts), bool)
    first[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(first)
    return text[begin], anchors[begin], starts[begin], np.diff(np.append(begin, len(starts)))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def _fields(id_type: T.DataType, **others: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("id", id_type), T.StructField("tie", T.LongType())]
        + [T.StructField(name, kind) for name, kind in others.items()]
    )


def repeated_windows(
    docs: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, tie, starts): first words of the windows that a row must lose, for rows that lose any.

    ``tie`` is the hash of the text; rows of one id with different texts are judged apart, and do
    not count as earlier than each other. Rows without an id neither lose nor own anything.
    """
    keyed = _keyed(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
    id_type = keyed.schema["id"].dataType

    def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in W.groups(batch.column("text")):
                w = W.words_of(data, offsets, W.AS_IS, W.NOT_BLANK)
                text, anchors, _, _ = _anchored(w, window, anchor)
                order = np.lexsort((anchors, text))
                text, anchors = text[order], anchors[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (anchors[1:] != anchors[:-1])
                rows = pa.array(row + text[new])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("tie").take(rows), pa.array(anchors[new])],
                    names=["id", "tie", "anchor"],
                )

    anchors = stored(keyed.mapInArrow(anchors_of, _fields(id_type, anchor=T.LongType())), "anchors")
    shared = (
        anchors.groupBy("anchor")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .where("least < most")
        .select("anchor")
    )
    routes = stored(
        anchors.join(shared, "anchor").groupBy("id", "tie").agg(F.collect_set("anchor").alias("anchors")),
        "routes",
    )

    def passages_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("anchors")
            for row, data, offsets in W.groups(batch.column("text")):
                w = W.words_of(data, offsets, W.AS_IS, W.NOT_BLANK)
                text, anchors, first, count = _anchored(w, window, anchor)
                own = wanted.slice(row, len(offsets) - 1)
                sizes = np.diff(own.offsets.to_numpy())
                keys = own.flatten().to_numpy()
                # A run is wanted if its anchor is among those of its own text.
                spread = np.repeat(np.arange(len(sizes)), sizes)
                keep = np.isin(_pair(text, anchors), _pair(spread, keys))
                text, anchors, first, count = (x[keep] for x in (text, anchors, first, count))
                rows = pa.array(row + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(rows),
                        batch.column("tie").take(rows),
                        pa.array(anchors),
                        pa.array(first - w.bounds[text]),
                        _joined(w, first, first + count + window - 1),
                    ],
                    names=["id", "tie", "anchor", "first", "passage"],
                )

    occurrences = stored(
        keyed.join(routes, ["id", "tie"]).mapInArrow(
            passages_of,
            _fields(id_type, anchor=T.LongType(), first=T.LongType(), passage=T.StringType()),
        ),
        "passages",
    )
    distinct = stored(
        occurrences.groupBy("anchor", "passage").agg(F.min("id").alias("owner")), "distinct-passages"
    )
    crowded = stored(
        distinct.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("anchor"),
        "crowded",
    )
    narrow = occurrences.select("id", "tie", "anchor", "first", F.xxhash64("passage").alias("digest"))
    if not crowded.isEmpty():
        single = distinct.join(crowded, "anchor").select(
            "anchor", "owner", F.xxhash64("passage").alias("digest"), F.posexplode(_windows("passage", window))
        )
        single = single.select("anchor", "owner", "digest", "pos", F.col("col").alias("passage"))
        windows = single.groupBy(F.xxhash64("passage").alias("anchor"), "passage").agg(F.min("owner").alias("owner"))
        parts = single.select(
            "anchor", "digest", "pos", F.xxhash64("passage").alias("part"), F.lit(True).alias("split")
        )
        narrow = (
            narrow.join(parts, ["anchor", "digest"], "left")
            .select(
                "id",
                "tie",
                F.coalesce("part", "anchor").alias("anchor"),
                (F.col("first") + F.coalesce("pos", F.lit(0))).alias("first"),
                F.coalesce("part", "digest").alias("digest"),
            )
        )
        distinct = distinct.join(crowded, "anchor", "left_anti").unionByName(windows)

    def owners_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.field("element", _arrow_id(id_type)))
        for shard in _shards(batches):
            automaton = SuffixAutomaton()
            split = [(a, p.split(" "), o, d) for a, p, o, d in shard]
            for _, passage, owner, _ in split:
                automaton.add(passage, owner)
            automaton.close()
            found = [automaton.owners(passage, window) for _, passage, _, _ in split]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a for a, _, _, _ in split], pa.int64()),
                    pa.array([d for _, _, _, d in split], pa.int64()),
                    pa.array(found, kind),
                ],
                names=["anchor", "digest", "owners"],
            )

    owners = (
        distinct.withColumn("digest", F.xxhash64("passage"))
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(
            owners_of,
            T.StructType(
                [
                    T.StructField("anchor", T.LongType()),
                    T.StructField("digest", T.LongType()),
                    T.StructField("owners", T.ArrayType(id_type)),
                ]
            ),
        )
    )
    lost = F.filter(
        F.transform("owners", lambda o, j: F.when(o < F.col("id"), F.col("first") + j)), lambda x: x.isNotNull()
    )
    hits = narrow.join(stored(owners, "owners"), ["anchor", "digest"]).select("id", "tie", lost.alias("s"))
    return stored(
        hits.where(F.size("s") > 0).groupBy("id", "tie").agg(F.flatten(F.collect_set("s")).alias("starts")),
        "repeated",
    )


def remove_repeated(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs`` but the text in a struct ``row``, with ``kept``, n_words, n_removed.

    Words are runs of characters other than ASCII white space, taken unchanged. A word goes if it
    lies in a run of ``window`` words that also starts in a row with a smaller id; ``kept`` is the
    other words joined by one space, or the text itself, ``unchanged``, is left to the caller where
    n_removed is 0. Null texts have no words; of equal texts the one with the least id keeps all;
    rows that agree in id and text have the same result; rows without an id lose nothing and own
    nothing; an empty table gives an empty result.
    """
    repeated = repeated_windows(docs, window, id_col=id_col, text_col=text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*rest).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text")
    ).join(repeated, ["id", "tie"], "left").select("row", "text", "starts")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("starts")
            for row, data, offsets in W.groups(batch.column("text")):
                w = W.words_of(data, offsets, W.AS_IS, W.NOT_BLANK)
                own = lists.slice(row, len(offsets) - 1)
                sizes = own.value_lengths().fill_null(0).to_numpy()
                first = own.flatten().to_numpy() + np.repeat(w.bounds[:-1], sizes)
                change = np.zeros(len(w.hashes) + 1, np.int64)
                np.add.at(change, first, 1)
                np.add.at(change, first + window, -1)
                kept = np.cumsum(change[:-1]) == 0
                before = np.concatenate([[0], np.cumsum(kept)])
                n_words = np.diff(w.bounds)
                n_kept = before[w.bounds[1:]] - before[w.bounds[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(row, len(n_words)),
                        _kept_texts(w, kept),
                        pa.array(n_words),
                        pa.array(n_words - n_kept),
                    ],
                    names=["row", "kept", "n_words", "n_removed"],
                )

    schema = T.StructType(
        [rows.schema["row"], T.StructField("kept", T.StringType())]
        + [T.StructField(name, T.LongType()) for name in ("n_words", "n_removed")]
    )
    return rows.mapInArrow(keep, schema)


def _pair(text: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    return W.mixed(anchors.view(np.uint64) ^ W.mixed(text.astype(np.uint64) + np.uint64(1)))


def _windows(passage: str, window: int):
    """All full windows of a passage, each as words joined by one space."""
    words = F.split(passage, " ")
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - F.lit(window - 1)),
        lambda at: F.array_join(F.slice(words, at, F.lit(window)), " "),
    )


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and its length, in a row."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def _joined(w: W.Words, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """For each pair the words first to last - 1, joined by one space."""
    words = _spread(first, last - first)
    return _strings(w, words, last - first)


def _strings(w: W.Words, words: np.ndarray, counts: np.ndarray) -> pa.Array:
    """``words`` in portions of ``counts``, each portion's words joined by one space."""
    sizes = w.ends[words] - w.starts[words] + 1  # each word and a blank after it
    out = w.data[np.minimum(_spread(w.starts[words], sizes), max(len(w.data) - 1, 0))]
    ends = np.cumsum(sizes)
    out[ends - 1] = 32
    edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    # The blank after a portion's last word is left out.
    keep = np.ones(len(out), bool)
    full = np.flatnonzero(counts > 0)
    keep[edges[full + 1] - 1] = False
    out = np.ascontiguousarray(out[keep])
    offsets = edges - np.concatenate([[0], np.cumsum(counts > 0)])
    return pa.LargeStringArray.from_buffers(
        len(counts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)
    ).cast(pa.string())


def _kept_texts(w: W.Words, kept: np.ndarray) -> pa.Array:
    before = np.concatenate([[0], np.cumsum(kept)])
    return _strings(w, np.flatnonzero(kept), before[w.bounds[1:]] - before[w.bounds[:-1]])


def _arrow_id(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Distinct passages in shards; all passages of an anchor are in one."""
    shard: list[tuple] = []
    words, last = 0, None
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("anchor", "passage", "owner", "digest")]
        for row in zip(*columns, strict=True):
            if words >= SHARD_WORDS and row[0] != last:
                yield shard
                shard, words = [], 0
            shard.append(row)
            words += row[1].count(" ") + 1
            last = row[0]
    if shard:
        yield shard
