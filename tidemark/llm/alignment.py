"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide pair counts.

Rows are shuffled by their full text, so that each distinct text is tokenised and aligned once and
carries its multiplicity. Tokens are byte ranges: where a token of each side ends, a group ends, and
tokens whose ranges overlap are linked. A pair of ids counts the documents that hold it linked: the
multiplicities of the distinct texts it is in.

Texts are aligned in blocks of bounded bytes. A block keeps its distinct id pairs, weighted, and for
each text which of them it holds and how often. The pairs of all blocks are summed by a shuffle on the
pair; the sums go back to the blocks that hold the pair, never anywhere whole, and give the measures
of each text. Those are joined to the ids of all rows with this text.

Within a text both tokenizers must split before a space that follows a character which is certainly no
white space (no entry of the piece vocabulary has its blank mark after another character; this is
checked when the model is loaded). Text between two such places is a piece; tokens and links of equal
pieces are found once per worker.
"""

from __future__ import annotations

import hashlib
import os
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.encoding import safe_cuts, text_groups
from tidemark.session import stored

# Texts of a block, in bytes; a longer one is a block of its own.
BLOCK_BYTES = 4_000_000
# What a worker remembers of pieces; beyond either bound it starts anew.
KNOWN_PIECES = 150_000
KNOWN_BYTES = 8_000_000

BLANK = "▁"
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def _byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters
    for themselves, characters from 256 on for the others in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Tokens of both sides for pieces of text, and their links; remembers pieces."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["RAYON_NUM_THREADS"] = "1"
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        # Their strings in a text are then ordinary text.
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        values = _byte_values()
        size = self.a.get_vocab_size()
        self.table_a = _Table([bytes(values.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(size)])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("an entry of the piece vocabulary goes on after a blank: texts cannot be cut there")
        self.table_b = _Table(
            [
                bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.measures = np.zeros((0, len(MEASURES)), np.int64)
        self.valid = np.zeros(0, bool)
        self.groups: list[bytes] = []
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)

    def slots(self, pieces: list[str]) -> np.ndarray:
        """Where each distinct piece's tokens and links are kept, after finding those not seen yet."""
        known = self.known
        found = np.fromiter((known.get(p, -1) for p in pieces), np.int64, len(pieces))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [pieces[k] for k in missing]
            found[missing] = np.arange(len(self.groups), len(self.groups) + len(new))
            self._add(new)
        return found

    def _add(self, new: list[str]) -> None:
        self.known.update(zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True))
        self.held += sum(map(len, new))
        data = [p.encode() for p in new]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        data = np.frombuffer(b"".join(data), np.uint8)
        # The piece side puts the leading space there itself.
        sides = [
            _Side(self.table_a, [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]),
            _Side(self.table_b, self.b.encode([p[1:] for p in new], num_threads=1)),
        ]
        valid = (sides[0].totals == lengths) & (sides[1].totals == lengths)
        inside = np.repeat(np.arange(len(new)), lengths)
        data, inside = data[valid[inside]], inside[valid[inside]]
        for side in sides:
            valid[inside[side.bytes_of(valid) != data]] = False
        a, b = (side.tokens_of(valid) for side in sides)
        bounds = np.cumsum(np.where(valid, lengths, 0))
        # A pair that overlaps does so in one run of bytes that holds no end of either side.
        ends_a, ends_b = np.cumsum(self.table_a.sizes[a]), np.cumsum(self.table_b.sizes[b])
        ends, both = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        links = (a[np.searchsorted(ends_a, ends)] << 32) | b[np.searchsorted(ends_b, ends)]
        # An end belongs to the first piece that reaches it.
        counts = [
            np.bincount(np.searchsorted(bounds, each), minlength=len(new)) for each in (ends_a, ends_b, both, ends)
        ]
        text, edges = _group_texts(a, b, np.searchsorted(both, ends_a), np.searchsorted(both, ends_b))
        before = np.concatenate([[0], np.cumsum(counts[0] + counts[1])])
        cuts = edges[before].tolist()
        self.groups.extend(text[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True))
        self.starts = np.concatenate([self.starts, len(self.pairs) + np.cumsum(counts[3]) - counts[3]])
        self.sizes = np.concatenate([self.sizes, counts[3]])
        self.pairs = np.concatenate([self.pairs, links])
        self.measures = np.concatenate([self.measures, np.stack(counts, axis=1)])
        self.valid = np.concatenate([self.valid, valid])


class _Table:
    """Byte strings by number, in a row."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return self.data[_expand(self.starts[numbers], self.sizes[numbers])]


class _Side:
    """Token ids of pieces on one side."""

    def __init__(self, table: _Table, ids: list[list[int]]):
        self.table = table
        self.counts = np.fromiter(map(len, ids), np.int64, len(ids))
        self.ids = np.fromiter(chain.from_iterable(ids), np.int64, int(self.counts.sum()))
        self.piece = np.repeat(np.arange(len(ids)), self.counts)
        self.totals = np.bincount(self.piece, table.sizes[self.ids], len(ids)).astype(np.int64)

    def tokens_of(self, picked: np.ndarray) -> np.ndarray:
        return self.ids[picked[self.piece]]

    def bytes_of(self, picked: np.ndarray) -> np.ndarray:
        return self.table.joined(self.tokens_of(picked))


_NUMBERS = None


def _group_texts(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All tokens as text, group by group: ids of one side joined by commas, a bar after side a and a
    semicolon after side b. Also where each token begins, and the end."""
    global _NUMBERS
    if _NUMBERS is None or len(_NUMBERS.sizes) <= max(a.max(initial=0), b.max(initial=0)):
        _NUMBERS = _Table([f"{i},".encode() for i in range(1 << int(max(a.max(initial=0), b.max(initial=0)) + 1).bit_length())])
    key = np.concatenate([2 * group_a, 2 * group_b + 1])
    order = np.argsort(key, kind="stable")
    key, ids = key[order], np.concatenate([a, b])[order]
    text = _NUMBERS.joined(ids)
    edges = np.concatenate([[0], np.cumsum(_NUMBERS.sizes[ids])])
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True)) if len(key) else np.zeros(0, np.int64)
    text[edges[last + 1] - 1] = np.where(key[last] % 2 == 0, ord("|"), ord(";"))
    return text.tobytes(), edges


def _worker_aligner(path_a: str, path_b: str) -> Aligner:
    kept = sys.__dict__.setdefault("_tidemark_aligners", {})
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Aligner(path_a, path_b)
    return kept[path_a, path_b]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each after a space, as bytes, and where their pieces start and the last one ends."""
    spaced = np.insert(data, offsets[:-1], 32)
    bounds = offsets + np.arange(len(offsets))
    marks = np.zeros(len(spaced) + 1, bool)
    cuts = safe_cuts(spaced)
    marks[cuts[spaced[cuts] == 32]] = True
    # A space that ends a text belongs to the piece before: alone it would get no piece token.
    marks[bounds[1:] - 1] = False
    marks[bounds] = True
    return spaced, np.flatnonzero(marks)


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of the amounts of each."""
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(amounts, first) if len(first) else amounts


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    plain = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(plain, "<u4").astype(np.int64)


BLOCK = T.StructType(
    [T.StructField("block", T.LongType()), T.StructField("text_keys", T.ArrayType(T.StringType()))]
    + [T.StructField(name, T.ArrayType(T.LongType())) for name in MEASURES]
    + [T.StructField("groups_sha256", T.ArrayType(T.StringType()))]
    + [T.StructField(name, T.ArrayType(T.LongType())) for name in ("held", "pairs", "weights")]
    + [T.StructField(name, T.BinaryType()) for name in ("links", "times")]
)


def _aligned(aligner: Aligner, keys: list, weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> dict:
    """One block: the measures of its texts, its distinct pairs and the links of each text to them."""
    if len(aligner.known) > KNOWN_PIECES or aligner.held > KNOWN_BYTES:
        aligner.forget()
    n = len(offsets) - 1
    spaced, cuts = _pieces(data, offsets)
    encoded = pa.LargeStringArray.from_buffers(
        len(cuts) - 1, pa.py_buffer(np.ascontiguousarray(cuts)), pa.py_buffer(np.ascontiguousarray(spaced))
    ).dictionary_encode()
    slots = aligner.slots(encoded.dictionary.to_pylist())[encoded.indices.to_numpy()]
    owner = np.searchsorted(offsets + np.arange(n + 1), cuts[:-1], "right") - 1
    invalid = np.zeros(n, bool)
    invalid[owner[~aligner.valid[slots]]] = True
    invalid |= np.diff(offsets) == 0
    slots, owner = slots[~invalid[owner]], owner[~invalid[owner]]
    block = {"text_keys": keys}
    for k, name in enumerate(MEASURES):
        before = np.concatenate([[0], np.cumsum(aligner.measures[slots, k])])
        ends = np.searchsorted(owner, np.arange(n + 1))
        block[name] = before[ends[1:]] - before[ends[:-1]]
    names = aligner.groups
    texts = (b"".join([names[s] for s in part.tolist()]) for part in np.split(slots, ends[1:-1]))
    # The last semicolon ends the text and separates nothing.
    block["groups_sha256"] = [hashlib.sha256(t[:-1]).hexdigest() if t else "" for t in texts]
    # Each text's distinct pieces, then its distinct pairs, with how often it holds them.
    size = max(len(names), 1)
    pieces, times = _summed(owner * size + slots, np.ones(len(slots), np.int64))
    text, slot = pieces // size, pieces % size
    sizes = aligner.sizes[slot]
    pairs, local = np.unique(aligner.pairs[_expand(aligner.starts[slot], sizes)], return_inverse=True)
    links, amounts = _summed(np.repeat(text, sizes) * max(len(pairs), 1) + local, np.repeat(times, sizes))
    text, local = links // max(len(pairs), 1), links % max(len(pairs), 1)
    total = np.zeros(len(pairs), np.int64)
    np.add.at(total, local, weights[text])
    block |= {"held": np.bincount(text, minlength=n), "pairs": pairs, "weights": total}
    return block | {"links": _packed(local), "times": _packed(amounts)}


def _blocks(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Blocks of distinct texts (columns text, text_key, weight)."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _worker_aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys = batch.column("text_key")
            weights = batch.column("weight").to_numpy()
            for row, data, offsets in text_groups(batch.column("text"), BLOCK_BYTES):
                n = len(offsets) - 1
                block = _aligned(aligner, keys.slice(row, n).to_pylist(), weights[row : row + n], data, offsets)
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number])]
                    + [
                        pa.array([block[f.name]], pa.binary())
                        if isinstance(f.dataType, T.BinaryType)
                        else pa.ListArray.from_arrays([0, len(block[f.name])], pa.array(block[f.name]))
                        for f in BLOCK.fields[1:]
                    ],
                    names=BLOCK.names,
                )

    return texts.mapInArrow(align, BLOCK)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The measures of each text of a block, from the counts of the block's pairs."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name).slice(k, 1) for name in batch.schema.names}
            flat = {
                name: row[name].flatten().to_numpy(zero_copy_only=False)
                for name in (*MEASURES, "held", "counts", "best")
            }
            held = flat["held"]
            total = int(held.sum())
            links = _unpacked(row["links"][0].as_py(), total)
            times = _unpacked(row["times"][0].as_py(), total)
            ends = np.concatenate([[0], np.cumsum(held)])
            arrays = [row["text_keys"].flatten(), *(pa.array(flat[name]) for name in MEASURES)]
            for each in (flat["best"].astype(np.int64), flat["counts"]):
                before = np.concatenate([[0], np.cumsum(each[links] * times)]).astype(np.int64)
                arrays.append(pa.array(before[ends[1:]] - before[ends[:-1]]))
            names = ["text_key", *MEASURES, "n_best", "count_sum"]
            yield pa.RecordBatch.from_arrays([*arrays, row["groups_sha256"].flatten()], names=[*names, "groups_sha256"])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold each id pair linked, and whether no other pair of the
    same first id has more. A pair is a_id * 2^32 + b_id."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p")).select("p.*")
    counts = stored(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("weights").alias("count")), "pairs")
    first = F.shiftright("pair", 32).alias("a")
    most = counts.groupBy(first).agg(F.max("count").alias("most"))
    return counts.withColumn("a", first).join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row of ``docs``.

    Side a is a byte-level tokenizer file, side b a piece model that puts a space before the text; both
    see a space and the text. Strings of special tokens are ordinary text. A text that is null, empty, or
    not given back byte by byte by either side has no tokens: zeros and an empty string. Repeated rows and
    rows without an id count as documents and have their result each; other columns are not read; an empty table
    gives an empty result.
    """
    text = F.col(text_col).cast("string")
    key = F.sha2(text, 256).alias("text_key")
    distinct = docs.where(text.isNotNull() & (text != "")).groupBy(text.alias("text")).agg(F.count("*").alias("weight"))
    blocks = stored(_blocks(distinct.select("text", F.sha2("text", 256).alias("text_key"), "weight"), path_a, path_b), "blocks")
    counts = pair_counts(blocks)
    held = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    known = (
        held.join(counts, "pair")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("k"))
        .select("block", F.col("k.count").alias("counts"), F.col("k.best").alias("best"))
    )
    none = F.array().cast("array<bigint>"), F.array().cast("array<boolean>")
    joined = blocks.drop("pairs", "weights").join(known, "block", "left")
    joined = joined.withColumns({"counts": F.coalesce("counts", none[0]), "best": F.coalesce("best", none[1])})
    sums = ", ".join(f"{name} long" for name in (*MEASURES, "n_best", "count_sum"))
    measured = stored(joined.mapInArrow(_measured, f"text_key string, {sums}, groups_sha256 string"), "measures")
    found = docs.select(F.col(id_col).alias("id"), key).join(measured, "text_key", "left")
    return found.select(
        "id",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in (*MEASURES, "n_best", "count_sum")],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
