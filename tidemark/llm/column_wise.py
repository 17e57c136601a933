"""Remove byte runs that an earlier place already has, by column-wise suffix sorting.

The suffixes of a collection of strings are sorted column by column: each round inserts one symbol of
every string, from the last to the first. A new suffix stands where the count of its symbol in the
Burrows-Wheeler transform so far puts it, and its common prefixes with both neighbours follow from
those of the suffixes one symbol shorter. After as many rounds as the longest string has symbols, all
suffixes are in order with their common prefixes, and equal windows stand together.

Whole documents would need a round for each byte of the longest one, and each round passes over the
whole collection. So the collections are made of short strings instead, and each fits a task:

1. Each window of bytes has an anchor, the least hash of the short runs inside it. Equal windows have
   equal anchors. Anchors that occur once are left out.
2. Around each shared anchor, a document gives a passage: the bytes of the neighbouring windows that
   have this anchor. Equal passages are one string, at their first place (least id, then start).
3. The distinct passages of some anchors, of which each has several, are a collection. Its sorted suffixes give each window's
   first place: the least of all equal windows.
4. What windows with an earlier first place cover is removed.

Passages of an anchor that do not fit a collection are cut by the place of the anchor in the window:
the windows of one class have a longer run in common, and this run is their new anchor. Classes of
``CLASS`` places are cut to single windows if need be, and then equal anchors are equal windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W
from tidemark.session import stored

WINDOW = 100
# Bytes of the run that anchors a window: long enough that few runs meet by chance.
ANCHOR = 32
# Bytes whose windows are anchored at a time; a longer text is taken in parts that overlap.
PART_BYTES = 400_000
# Bytes of a collection; it ends with the anchor that passes this. About half of them are passages alone
# under their anchor, which need no sorting.
COLLECTION_BYTES = 200_000
# Bytes of an anchor's distinct passages beyond which they are cut into classes.
CROWDED_BYTES = 2_000_000
CLASS = 8

_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20250102).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sorted_suffixes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of all strings in order: string, length and common prefix with the one before.

    Strings are at most 255 bytes long. Equal suffixes stand in any order.
    """
    m = len(offsets) - 1
    lengths = np.diff(offsets)
    # One row for each suffix so far; the first m are the empty ones, by string. Common prefixes are
    # those with the row before.
    common = np.zeros(m + 1, np.uint8)
    place = np.arange(m)  # the row of the longest suffix so far, by string
    # The transform without its open ends: symbol and row, ascending. The k-th entry belongs to the
    # suffix in row m + k, which is that of its row with the symbol before.
    keys = np.zeros(0, np.int64)
    low = np.int64(0xFFFFFFFF)
    for turn in range(int(lengths.max(initial=0))):
        active = np.flatnonzero(lengths > turn)
        new = (data[offsets[active + 1] - 1 - turn].astype(np.int64) << 32) | place[active]
        order = np.argsort(new)
        new, active = new[order], active[order]
        behind = np.searchsorted(keys, new)  # the old entries that the new ones stand before
        at = behind + np.arange(len(new))
        old = np.ones(len(keys) + len(new), bool)
        old[at] = False
        merged = np.empty(len(old), np.int64)
        merged[at], merged[old] = new, keys
        # A new row, and an old one behind a new one, have a common prefix with the row before of one
        # symbol, if it is the same, and the least of those between the rows the symbols stand in.
        last = at[np.append(np.diff(at) > 1, True)] + 1
        touched = np.concatenate([at, last])
        touched = touched[(touched > 0) & (touched < len(merged))]
        before, here = merged[touched - 1], merged[touched]
        same = (before >> 32) == (here >> 32)
        touched, before, here = touched[same], before[same] & low, here[same] & low
        kept = np.ones(m + len(merged) + 1, bool)
        kept[m + at] = False
        longer = np.zeros(len(kept), np.uint8)
        longer[kept] = common
        if len(touched):
            by_row = np.argsort(before)
            ranges = np.empty(2 * len(touched), np.int64)
            ranges[::2], ranges[1::2] = before[by_row] + 1, here[by_row] + 1
            longer[m + touched[by_row]] = np.minimum.reduceat(common, ranges)[::2] + 1
        # Each row moves by the number of new ones before it.
        edges = np.concatenate([[0], m + behind, [len(common)]])
        moved = np.repeat(np.arange(len(new) + 1), np.diff(edges))
        merged += moved[merged & low]
        place[active] = m + at
        keys, common = merged, longer
    step = np.zeros(m + len(keys), np.int64)
    step[keys & low] = m + np.arange(len(keys))
    string, size = np.empty(len(step), np.int64), np.empty(len(step), np.int64)
    row = whose = np.arange(m)
    for turn in range(int(lengths.max(initial=0)) + 1):
        string[row], size[row] = whose, turn
        going = lengths[whose] > turn
        row, whose = step[row[going]], whose[going]
    return string, size, common[:-1]


def first_places(
    data: np.ndarray, offsets: np.ndarray, window: int, ranks: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each string, in a row: the string whose place is first among equal windows,
    and the window's start in it. A place is (rank, start of the string + start in it)."""
    string, size, common = sorted_suffixes(data, offsets)
    group = np.cumsum(common < window)
    full = np.flatnonzero(size >= window)
    string, group = string[full], group[full]
    inside = np.diff(offsets)[string] - size[full]
    order = np.lexsort((starts[string] + inside, ranks[string], group))
    string, inside, group = string[order], inside[order], group[order]
    new = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    counts = np.maximum(np.diff(offsets) - window + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    by, start = np.empty(int(bounds[-1]), np.int64), np.empty(int(bounds[-1]), np.int64)
    window_of = bounds[string] + inside
    by[window_of], start[window_of] = string[first], inside[first]
    return by, start


def _run_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` bytes."""
    n = len(data) - size + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * W.powers(_BASE, len(data)), out=sums[1:])
    found = sums[size:] - sums[:-size]
    found *= W.powers(_INVERSE, n)
    return W.mixed(found)


def anchored(data: np.ndarray, offsets: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows of one text with one anchor at one place: text, hash and place of
    the anchor, first window, number of windows. Of equal anchors in a window the leftmost counts."""
    reach = window - anchor
    # Texts shorter than a window have none.
    last = offsets[1:] - window
    counts = np.maximum(last + 1 - offsets[:-1], 0)
    if not counts.any():
        return (np.zeros(0, np.int64),) * 5
    runs = _run_hashes(data, anchor)
    rank = (runs >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _sliding(rank, reach + 1, np.minimum)
    windows = np.repeat(offsets[:-1] - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
    shown = np.zeros(len(least), np.uint32)
    shown[windows] = least[windows]
    # A run is an anchor where it is the least of some window. Windows across texts do not count.
    none = np.zeros(reach, np.uint32)
    place = np.flatnonzero(_sliding(np.concatenate([none, shown, none]), reach + 1, np.maximum) == rank)
    text = np.searchsorted(offsets, place, "right") - 1
    # Neighbouring windows with one least value, and the anchors of that value in them, in order: the
    # leftmost anchor changes from left to right only.
    value = least[windows]
    opens = np.ones(len(windows), bool)
    opens[1:] = (value[1:] != value[:-1]) | (windows[1:] != windows[:-1] + 1)
    begin = np.flatnonzero(opens)
    end = windows[np.append(begin[1:], len(windows)) - 1]
    begin = windows[begin]
    tied = np.zeros(len(place), bool)
    tied[1:] = (rank[place[1:]] == rank[place[:-1]]) & (np.diff(place) <= reach + 1) & (text[1:] == text[:-1])
    group = np.cumsum(~tied) - 1
    first = np.where(tied, np.concatenate([[0], place[:-1] + 1]), begin[group])
    final = np.minimum(place, end[group])
    real = final >= first
    return tuple(x[real] for x in (text, runs[place].view(np.int64), place, first, final - first + 1))


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


def _parts(column: pa.Array, window: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts in groups, and long ones in parts: first row, start in the text, bytes, offsets. Each
    window lies in one part."""
    for row, data, offsets in W.groups(column, PART_BYTES):
        if len(offsets) > 2 or len(data) <= PART_BYTES:
            yield row, 0, data, offsets
            continue
        for at in range(0, len(data) - window + 1, PART_BYTES):
            part = data[at : at + PART_BYTES + window - 1]
            yield row, at, part, np.array([0, len(part)])


def _slices(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """data[start : start + size] of each pair."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))]
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), buffers)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def _fields(kind: T.StructField, **others: str) -> T.StructType:
    rest = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in others.items()))
    return T.StructType([kind, *rest.fields])


def _anchors(keyed: DataFrame, window: int, anchor: int) -> DataFrame:
    """(id, tie, key, n): how often each anchor occurs in a row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in _parts(batch.column("text"), window):
                text, value, _, _, _ = anchored(data, offsets, window, anchor)
                order = np.lexsort((value, text))
                text, value = text[order], value[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
                begin = np.flatnonzero(new)
                rows = pa.array(row + text[begin])
                times = np.diff(np.append(begin, len(text)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("tie").take(rows), pa.array(value[begin]), pa.array(times)],
                    names=["id", "tie", "key", "n"],
                )

    return keyed.mapInArrow(find, _fields(keyed.schema["id"], tie="long", key="long", n="long"))


def _passages(routed: DataFrame, window: int, anchor: int) -> DataFrame:
    """(id, tie, key, first, at, passage) of the anchors listed in ``keys``: where the passage starts in
    the text and the anchor in the passage."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, start, data, offsets in _parts(batch.column("text"), window):
                text, value, place, first, n = anchored(data, offsets, window, anchor)
                lists = batch.column("keys").slice(row, len(offsets) - 1)
                wanted = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
                listed = np.sort(_both(wanted, lists.flatten().to_numpy()))
                found = _both(text, value)
                at = np.searchsorted(listed, found)
                keep = (at < len(listed)) & (listed[np.minimum(at, len(listed) - 1)] == found)
                text, value, place, first, n = (x[keep] for x in (text, value, place, first, n))
                rows = pa.array(row + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(rows),
                        batch.column("tie").take(rows),
                        pa.array(value),
                        pa.array(start + first - offsets[text]),
                        pa.array(place - first),
                        _slices(data, first, n + window - 1),
                    ],
                    names=["id", "tie", "key", "first", "at", "passage"],
                )

    schema = _fields(routed.schema["id"], tie="long", key="long", first="long", at="long", passage="binary")
    return routed.select("id", "tie", "text", "keys").mapInArrow(cut, schema)


def _both(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    return W.mixed(value.view(np.uint64) ^ W.mixed(text.astype(np.uint64) + np.uint64(1)))


def _collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in collections of about COLLECTION_BYTES; all rows of a key are in one."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        sizes = pc.binary_length(batch.column("passage")).to_numpy(zero_copy_only=False).astype(np.int64)
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        begin = 0
        for at, more in zip(edges.tolist(), np.add.reduceat(sizes, edges).tolist(), strict=True):
            if size >= COLLECTION_BYTES and (at or keys[0] != last):
                yield pa.concat_batches([*held, batch.slice(begin, at - begin)])
                held, begin, size = [], at, 0
            size += more
        held.append(batch.slice(begin))
        last = keys[-1]
    if held:
        yield pa.concat_batches(held)


def _owners(distinct: DataFrame, window: int) -> DataFrame:
    """(key, digest, offset, n, owner, start): for runs of windows of a distinct passage the place of
    the first equal ones."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _collections(batches):
            key = rows.column("key").to_numpy()
            alone = np.ones(len(key) + 1, bool)
            alone[1:-1] = key[1:] != key[:-1]
            alone = alone[1:] & alone[:-1]
            # The windows of a passage differ in the place of the anchor, so without another passage
            # under the anchor each is the first of its kind.
            own = rows.filter(pa.array(alone))
            n = pc.subtract(pc.binary_length(own.column("passage")), window - 1).cast(pa.int64())
            none = pa.array(np.zeros(len(own), np.int64))
            columns = [own.column("key"), own.column("digest"), none, n, own.column("id"), own.column("first")]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            rows = rows.filter(pa.array(~alone))
            if not rows.num_rows:
                continue
            _, ends, data = rows.column("passage").cast(pa.large_binary()).buffers()
            offsets = np.frombuffer(ends, np.int64, len(rows) + 1)
            data = np.frombuffer(data, np.uint8)
            ids, firsts = rows.column("id"), rows.column("first").to_numpy()
            ranks = pc.rank(ids, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
            by, start = first_places(data, offsets, window, ranks, firsts)
            counts = np.diff(offsets) - window + 1
            string = np.repeat(np.arange(len(counts)), counts)
            offset = np.arange(len(string)) - np.repeat(np.cumsum(counts) - counts, counts)
            shift = start - offset
            new = np.ones(len(string), bool)
            new[1:] = (string[1:] != string[:-1]) | (by[1:] != by[:-1]) | (shift[1:] != shift[:-1])
            begin = np.flatnonzero(new)
            mine = pa.array(string[begin])
            columns = [
                rows.column("key").take(mine),
                rows.column("digest").take(mine),
                pa.array(offset[begin]),
                pa.array(np.diff(np.append(begin, len(string)))),
                ids.take(pa.array(by[begin])),
                pa.array(firsts[by[begin]] + start[begin]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["key", "digest", "offset", "n", "owner", "start"]
    owner = T.StructField("owner", distinct.schema["id"].dataType)
    rest = T.StructType.fromDDL("key long, digest long, offset long, n long").fields
    schema = T.StructType([*rest, owner, T.StructField("start", T.LongType())])
    dealt = distinct.select("key", "passage", F.xxhash64("passage").alias("digest"), "id", "first")
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(find, schema)


def _distinct(passages: DataFrame) -> DataFrame:
    """(key, passage, at, id, first): each passage of a key once, at its first place."""
    place = F.min(F.struct("id", "first")).alias("o")
    return passages.groupBy("key", "passage", "at").agg(place).select("key", "passage", "at", "o.id", "o.first")


def _classes(crowded: DataFrame, window: int, reach: int, width: int) -> DataFrame:
    """``crowded`` passages cut to windows whose anchor lies in one class of ``width`` places, with what
    all windows of the class have in common as their anchor: (key, digest) of the passage they are cut
    from, offset in it, and the columns of a distinct passage under the names part_*."""
    n = F.octet_length("passage") - (window - 1)
    # Window j has the anchor at place at - j.
    low = F.greatest(F.col("at") - n + 1, F.col("class") * width)
    high = F.least(F.col("at"), F.col("class") * width + width - 1)
    classes = F.sequence(F.floor((F.col("at") - n + 1) / width), F.floor(F.col("at") / width))
    each = crowded.withColumn("digest", F.xxhash64("passage")).withColumn("class", F.explode(classes))
    each = each.withColumns({"low": low, "high": high, "offset": F.col("at") - high})
    common = F.expr(f"substring(passage, CAST(at - class * {width} + 1 AS INT), {window - width + 1})")
    part = F.expr(f"substring(passage, CAST(offset + 1 AS INT), CAST(high - low + {window} AS INT))")
    return each.select(
        "key",
        "digest",
        "offset",
        F.xxhash64("key", "class", common).alias("part_key"),
        part.alias("part_passage"),
        F.col("high").alias("part_at"),
        F.col("id").alias("part_id"),
        (F.col("first") + F.col("offset")).alias("part_first"),
    )


def _all_owners(distinct: DataFrame, window: int, reach: int, widths: tuple[int, ...] = (CLASS, 1)) -> DataFrame:
    """Owners of all passages; those of crowded keys by their classes."""
    size = F.sum(F.octet_length("passage"))
    crowded = stored(distinct.groupBy("key").agg(size.alias("b")).where(F.col("b") > CROWDED_BYTES).select("key"), "crowded")
    if not widths or crowded.isEmpty():
        return stored(_owners(distinct, window), "owners")
    parts = stored(_classes(distinct.join(crowded, "key"), window, reach, widths[0]), "classes")
    picked = [F.col(f"part_{c}").alias(c) for c in ("key", "passage", "at", "id", "first")]
    below = _all_owners(stored(_distinct(parts.select(*picked)), "distinct-classes"), window, reach, widths[1:])
    links = parts.select(
        "key", "digest", F.col("offset").alias("o"), F.col("part_key"), F.xxhash64("part_passage").alias("part_digest")
    )
    found = below.withColumnsRenamed({"key": "part_key", "digest": "part_digest"}).join(links, ["part_key", "part_digest"])
    found = found.select("key", "digest", (F.col("o") + F.col("offset")).alias("offset"), "n", "owner", "start")
    rest = distinct.join(crowded, "key", "left_anti")
    return stored(_owners(rest, window).unionByName(found), "owners")


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, tie, spans): start and end of byte runs that a row must lose, for rows that lose any; they may
    overlap. ``tie`` is the hash of the text. Rows without an id neither lose nor own anything."""
    if 2 * window - anchor > 255:
        raise ValueError("passages of such windows are over 255 bytes")
    keyed = _keyed(docs.where(F.col(id_col).isNotNull()), id_col, text_col).where(F.octet_length("text") >= window)
    anchors = stored(_anchors(keyed, window, anchor), "anchors")
    shared = anchors.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    routes = anchors.join(shared, "key").groupBy("id", "tie").agg(F.collect_list("key").alias("keys"))
    routed = keyed.join(stored(routes, "routes"), ["id", "tie"])
    passages = stored(_passages(routed, window, anchor), "passages")
    distinct = stored(_distinct(passages), "distinct")
    owners = _all_owners(distinct, window, window - anchor)
    places = passages.select("id", "tie", "key", "first", F.xxhash64("passage").alias("digest"))
    here = F.col("first") + F.col("offset")
    hits = places.join(owners, ["key", "digest"]).where(
        (F.col("owner") < F.col("id")) | ((F.col("owner") == F.col("id")) & (F.col("start") < here))
    )
    span = F.struct(here.alias("begin"), (here + F.col("n") + window - 1).alias("end"))
    return stored(hits.groupBy("id", "tie").agg(F.collect_list(span).alias("spans")), "spans")


def remove_repeated(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs`` but the text in a struct ``row``, with the remaining bytes as
    ``kept``, n_bytes, n_removed and n_spans, the number of runs removed.

    A byte goes if a run of ``window`` bytes over it also starts at an earlier place: in a row with a
    smaller id, or earlier in a row of the same id. Overlapping runs count, and runs are judged on the
    texts as given. Null texts are empty; a text shorter than the window keeps all; rows that agree in
    id and text have the same result; rows without an id lose nothing and own nothing; an empty table
    gives an empty result.
    """
    spans = repeated_spans(docs, window, anchor, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*rest).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text")
    ).join(spans, ["id", "tie"], "left")
    rows = rows.select("row", "text", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in W.groups(batch.column("text")):
                n = len(offsets) - 1
                begins, ends = (batch.column(c).slice(row, n) for c in ("begins", "ends"))
                kept = np.ones(len(data), bool)
                if len(begins.flatten()):
                    base = np.repeat(offsets[:-1], pc.fill_null(pc.list_value_length(begins), 0).to_numpy())
                    change = np.zeros(len(data) + 1, np.int32)
                    np.add.at(change, base + begins.flatten().to_numpy(), 1)
                    np.add.at(change, base + ends.flatten().to_numpy(), -1)
                    kept = np.cumsum(change[:-1], dtype=np.int32) == 0
                # A run begins at a byte that goes after one that stays, or at the start of a text.
                opens = ~kept
                inner = np.ones(len(data), bool)
                inner[offsets[:-1][np.diff(offsets) > 0]] = False
                opens[1:] &= kept[:-1] | ~inner[1:]
                n_kept = np.diff(offsets) - _counts(~kept, offsets)
                n_spans = _counts(opens, offsets)
                edges = np.concatenate([[0], np.cumsum(n_kept)]).astype(np.int32)
                left = [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data[kept]))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(row, n),
                        pa.BinaryArray.from_buffers(pa.binary(), n, left),
                        pa.array(np.diff(offsets)),
                        pa.array(np.diff(offsets) - n_kept),
                        pa.array(n_spans),
                    ],
                    names=["row", "kept", "n_bytes", "n_removed", "n_spans"],
                )

    counts = T.StructType.fromDDL("kept binary, n_bytes long, n_removed long, n_spans long")
    return rows.mapInArrow(keep, T.StructType([rows.schema["row"], *counts.fields]))


def _counts(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(marks), offsets))
