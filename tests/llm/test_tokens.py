"""Token ids, counts, files and packing against the library and brute force."""

from __future__ import annotations

import functools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm import encoding, packing, token_files
from tidemark.llm.queries import QUERIES
from tidemark.llm.token_counts import count_tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"

TEXTS = [None, "", "a", "x" * 30_000, "one two\n\n three's <|endoftext|>é", "日本語 text", "one two\n\n three's <|endoftext|>é"]
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("ids", T.StringType()),
    ]
)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", None) for i, t in rows], DOCS)


@functools.cache
def tokenizer(path):
    return Tokenizer.from_file(path)


def ids(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("window", [8_000_000, 50, 5])
def test_pieces_give_the_ids_of_the_whole_text(path, window, monkeypatch):
    monkeypatch.setattr(encoding, "WINDOW_BYTES", window)
    parts = "a B é ß İ Σ 日本 ́ ' 's 'LL don't <|endoftext|> <|startoftext|> | <| 1 23 . !? 😀".split(" ")
    parts += [" ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "﻿"]
    chance = random.Random(7)
    texts = ["".join(chance.choices(parts, k=chance.randint(0, 30))) for _ in range(1500)] + TEXTS
    whole = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    data, offsets = encoding.text_bytes(pa.array(texts))
    flat, counts = encoding.PieceEncoder(path).ids_of(data, offsets)
    got = [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in whole]
    assert encoding.PieceEncoder(path).lengths_of(data, offsets).tolist() == counts.tolist()


def test_forgetting_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr(encoding, "KNOWN_PIECES", 2)
    encoder = encoding.PieceEncoder(BYTES)
    for _ in range(3):
        data, offsets = encoding.text_bytes(pa.array(["one two three", "two one four"]))
        flat, counts = encoder.ids_of(data, offsets)
        assert flat.tolist() == ids(BYTES, "one two three") + ids(BYTES, "two one four")


class Counted:
    """A tokenizer that notes how many pieces each call encodes."""

    def __init__(self, path):
        self.calls = []
        self.path = path

    def encode_batch_fast(self, pieces, **options):
        self.calls.append(len(pieces))
        return tokenizer(self.path).encode_batch_fast(pieces, **options)


def test_pieces_of_several_windows_are_encoded_once():
    encoder = encoding.PieceEncoder(BYTES)
    encoder.tokenizer = Counted(BYTES)
    data, offsets = encoding.text_bytes(pa.array([" ".join(map(str, range(first, first + 90_000))) for first in (0, 90_000)]))
    first, _ = encoder.ids_of(data, offsets)
    sent = sum(encoder.tokenizer.calls)
    assert sent == 180_000
    again, _ = encoder.ids_of(data, offsets)
    assert sum(encoder.tokenizer.calls) == sent
    assert again.tolist() == first.tolist()


def test_forgetting_by_ids_changes_nothing(monkeypatch):
    monkeypatch.setattr(encoding, "KNOWN_IDS", 3)
    encoder = encoding.PieceEncoder(BYTES)
    for text in ("one two three four", "four five", "one two three four"):
        flat, _ = encoder.ids_of(*encoding.text_bytes(pa.array([text])))
        assert flat.tolist() == ids(BYTES, text)
        assert encoder.filled <= 7


def test_counts_of_odd_rows(spark, rows):
    got = rows(count_tokens(frame(spark, list(enumerate(TEXTS)) + [(None, "a")]), WORDS, limit=3))
    want = [(i, len((t or "").encode()), len(ids(WORDS, t))) for i, t in [*enumerate(TEXTS), (None, "a")]]
    assert sorted(got, key=str) == sorted([(*w, w[2] > 3) for w in want], key=str)
    assert count_tokens(frame(spark, []), WORDS).count() == 0


def test_new_pieces_are_encoded_in_portions():
    encoder = encoding.PieceEncoder(BYTES)
    encoder.tokenizer = Counted(BYTES)
    text = " ".join(map(str, range(20_000)))
    flat, counts = encoder.ids_of(*encoding.text_bytes(pa.array([text])))
    assert flat.tolist() == ids(BYTES, text) and counts.tolist() == [len(flat)]
    assert len(encoder.tokenizer.calls) > 1 and max(encoder.tokenizer.calls) <= encoding.NEW_PIECES


def test_token_files_hold_all_ids_in_order(spark):
    rows = [(9, "b c"), (-3, None), (5, "x " * 9000), (5, "x " * 9000), (None, "first"), (7, "")]
    manifest = token_files.write_token_files(frame(spark, rows), BYTES, length=16)
    got = [tuple(r) for r in token_files.read_token_files(manifest, T.LongType()).collect()]
    want, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = [*ids(BYTES, text), 0]
        want.append((i, start, len(own), crc(own)))
        start += len(own)
    assert sorted(got, key=str) == sorted(want, key=str)
    empty = token_files.write_token_files(frame(spark, []), BYTES)
    assert token_files.read_token_files(empty, T.LongType()).count() == 0


def test_ids_beyond_the_width_raise(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    with pytest.raises(Exception, match="token id 65536 is over 65535"):
        token_files.write_token_files(docs, BYTES, end_id=65536)
    manifest = token_files.write_token_files(docs, BYTES, end_id=65536, wide=True)
    got = {r["doc_id"]: r["ids_crc32"] for r in token_files.read_token_files(manifest, T.LongType()).collect()}
    assert got == {1: crc([*ids(BYTES, "a b"), 65536]), 2: crc([65536])}
    token_files.write_token_files(docs, BYTES, end_id=65535)


def test_sequences_are_read_in_place(spark):
    text = " ".join(f"word{i}" for i in range(5000))
    shard = token_files.write_token_files(frame(spark, [(1, text)]), BYTES, length=8).collect()[0]
    stream = [*ids(BYTES, text), 0]
    reader = token_files.open_mapped(shard["ids_path"])
    for i in (0, 1, 255, 256, shard["n_sequences"] - 1):
        values, mask = token_files.sequence(reader, i)
        real = stream[8 * i : 8 * i + 8]
        assert values.tolist()[: len(real)] == real and mask.sum() == len(real)


def check_packing(got, texts, capacity):
    pieces = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, text in texts:
        own = [*ids(BYTES, text), 2]
        mine = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert all(r["length"] == capacity for r in mine[1:])
        at = 0
        for r in mine:
            assert r["start"] == at and crc(own[at : at + r["length"]]) == r["ids_crc32"]
            at += r["length"]
        assert at == len(own)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_of_the_table(spark):
    got = QUERIES["op7_packing"](spark, SF_DIR).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    used = check_packing(got, texts, 1024)
    assert used <= 1.02 * sum(r["length"] for r in got) / 1024 + 1


def test_packing_of_odd_rows(spark):
    texts = list(enumerate(TEXTS))
    packed = packing.pack(frame(spark, texts), BYTES, capacity=64)
    got = [r.asDict() | {"ids_crc32": zlib.crc32(r["ids"])} for r in packed.collect()]
    check_packing(got, texts, 64)
    assert packing.pack(frame(spark, []), BYTES).count() == 0
    for r in packing.sequences(packed).collect():
        assert sum(r["lengths"]) * 4 == len(r["ids"]) <= 256


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_piece_once(seed):
    chance = random.Random(seed)
    histogram = {chance.randint(1, 50): chance.choice([1, 2, 7, 1000, 10**7]) for _ in range(30)}
    plan = packing.solve(dict(histogram), 50, steps=60)
    placed = {}
    for content, times in plan:
        assert sum(s * n for s, n in content.items()) <= 50
        for s, n in content.items():
            placed[s] = placed.get(s, 0) + n * times
    assert placed == histogram


def test_knapsack_is_optimal():
    sizes, price = np.array([3, 5, 7]), np.array([3.0, 5.5, 8.1])
    best = packing.best_configuration(price, sizes, 17)
    value = sum(dict(zip(sizes, price))[s] * n for s, n in best.items())
    brute = max(
        3 * a + 5.5 * b + 8.1 * c for a in range(6) for b in range(4) for c in range(3) if 3 * a + 5 * b + 7 * c <= 17
    )
    assert value == pytest.approx(brute)


def test_counts_and_files_of_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in QUERIES["op5_token_counts"](spark, SF_DIR).collect():
        assert r["n_tokens"] == len(ids(WORDS, texts[r["doc_id"]]))
    start = 0
    for r in sorted(QUERIES["op2_token_files"](spark, SF_DIR).collect()):
        own = [*ids(BYTES, texts[r["doc_id"]]), 0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(own), crc(own))
        start += len(own)
