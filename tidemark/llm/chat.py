"""Chat transcripts as token ids with a loss mask.

Formatted text marks each turn. A turn of the assistant is ``<s>`` text ``</s>``; a turn of any other
role is ``[INST]`` role, line end, text ``[/INST]``. The marks are reserved ids beyond the
tokenizer's vocabulary, spliced between segments that are encoded on their own, so no content can
give them; the strings of the marks inside contents are escaped too, reversibly, so that the
formatted text can be told apart as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.encoding import text_bytes, worker_encoder
from tidemark.session import stored

# The marks, in order of their reserved ids, and the tokenizer's own special token.
MARKS = ("<s>", "</s>", "[INST]", "[/INST]")
RESERVED = (*MARKS, "<|endoftext|>")
ASSISTANT = "assistant"

_SPECIAL = re.compile(r"\\|" + "|".join(re.escape(s) for s in RESERVED))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_ROLE = re.compile(r"((?:[^\\\n]|\\.)*)\n(.*)", re.DOTALL)


def escape(text: str) -> str:
    """Double each backslash and put one behind the first character of each control string."""
    return _SPECIAL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _escaped_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def format_conversations(
    turns: DataFrame,
    tokenizer: str,
    first_reserved: int = 50257,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row (id, position, first, ids, mask) for each turn, written once and read back.

    ``position`` counts the turns of a conversation from 0, ordered by turn, role and text, nulls
    first; ``first`` counts the ids of the conversation's turns before, so that the rows of a
    conversation, put together, are its sequence; ``mask`` is true for the text of the assistant and
    for nothing else. Null texts and roles are empty; repeated rows are turns of their own; rows
    without an id are one conversation; other columns are not read. Turns are encoded where they
    are; only their order meets in a window, sorted and spilled by Spark, never held whole.
    """
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    rows = turns.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            roles = [r or "" for r in batch.column("role").to_pylist()]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            speaks = np.array([r == ASSISTANT for r in roles], bool)
            heads = ["" if own else _escaped_role(r) + "\n" for r, own in zip(roles, speaks, strict=True)]
            segments = [s for pair in zip(heads, map(escape, texts), strict=True) for s in pair]
            flat, sizes = encoder.ids_of(*text_bytes(pa.array(segments, pa.large_string())))
            ids, mask, lengths = _spliced(flat, sizes, speaks, first_reserved)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "turn", "role", "text")),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(mask)),
                ],
                names=["id", "turn", "role", "text", "ids", "mask"],
            )

    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("mask", T.ArrayType(T.BooleanType())),
        ]
    )
    before = F.sum(F.size("ids")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.mapInArrow(encode, schema).select(
        "id",
        (F.row_number().over(order) - 1).alias("position"),
        F.coalesce(before, F.lit(0)).alias("first"),
        "ids",
        "mask",
    )
    return stored(placed, "chat").withColumnRenamed("id", id_col)


def _spliced(
    flat: np.ndarray, sizes: np.ndarray, speaks: np.ndarray, first_reserved: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids with the marks around each turn, the loss mask by prefix sums, and ids of each turn."""
    head, body = sizes[::2], sizes[1::2]
    lengths = head + body + 2
    ends = np.cumsum(lengths)
    starts = ends - lengths
    content = np.ones(int(lengths.sum()), bool)
    content[starts] = content[ends - 1] = False
    ids = np.zeros(len(content), np.uint32)
    ids[content] = flat
    ids[starts] = first_reserved + np.where(speaks, 0, 2)
    ids[ends - 1] = first_reserved + np.where(speaks, 1, 3)
    change = np.zeros(len(content) + 1, np.int64)
    np.add.at(change, (starts + 1)[speaks], 1)
    np.add.at(change, (ends - 1)[speaks], -1)
    return ids, np.cumsum(change[:-1]) > 0, lengths


def conversation_digests(
    formatted: DataFrame, tokenizer: str, first_reserved: int = 50257, id_col: str = "conv_id"
) -> DataFrame:
    """What a formatted table says of each conversation, decoded from its ids and mask.

    (id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). The turns of a
    conversation pass by in order and only the running digests are held, however long it is.
    """
    sorted_rows = formatted.select(F.col(id_col).alias("id"), "position", "ids", "mask").repartition("id")
    sorted_rows = sorted_rows.sortWithinPartitions("id", "position")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_encoder(tokenizer).tokenizer
        names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        current, ready, keys = None, [], []
        for batch in batches:
            for at, turn in enumerate(_decoded(batch, decoder, first_reserved)):
                key = batch.column("id").slice(at, 1)
                if current is None or current[0] != key:
                    if current is not None:
                        keys.append(current[0])
                        ready.append(current[1].result())
                    current = (key, _Running())
                current[1].add(*turn)
            if len(ready) >= 1000:
                yield _batch(keys, ready, names)
                keys, ready = [], []
        if current is not None:
            yield _batch([*keys, current[0]], [*ready, current[1].result()], names)

    schema = T.StructType(
        [
            T.StructField("id", sorted_rows.schema["id"].dataType),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )
    return sorted_rows.mapInArrow(digest, schema).withColumnRenamed("id", id_col)


class _Running:
    """Digests of one conversation so far."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, role: str, text: str, loss: str, chars: int) -> None:
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())
        self.n_turns += 1
        self.loss_chars += len(loss)
        self.chars += chars

    def result(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _decoded(batch: pa.RecordBatch, decoder, first_reserved: int) -> Iterator[tuple]:
    """Role, text, text under the mask and length in characters of each turn of a batch."""
    ids = [np.asarray(x.values) for x in batch.column("ids")]
    masks = [x.values.to_numpy(zero_copy_only=False) for x in batch.column("mask")]
    contents = decoder.decode_batch([x[1:-1].tolist() for x in ids], skip_special_tokens=False)
    losses = decoder.decode_batch([x[m].tolist() for x, m in zip(ids, masks, strict=True)], skip_special_tokens=False)
    for x, content, loss in zip(ids, contents, losses, strict=True):
        opens, closes = MARKS[x[0] - first_reserved], MARKS[x[-1] - first_reserved]
        role, text = ASSISTANT, content
        if opens != MARKS[0]:
            role, text = _ROLE.fullmatch(content).groups()
        chars = len(opens) + len(content) + len(closes)
        yield unescape(role), unescape(text), unescape(loss), chars


def _batch(keys: list[pa.Array], ready: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(list(column)) for column in zip(*ready, strict=True)]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(keys), *columns], names=["id", *names])
