"""Token alignment against brute force over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
NOTHING = (0, 0, 0, 0, 0, 0, "")


def decoder():
    """Byte of each character of a byte-level vocabulary."""
    plain = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    table, more = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            table[chr(more)] = b
            more += 1
    return table


def by_hand(rows):
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of (id, text) rows."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    table = decoder()
    found, count = [], Counter()
    for _, text in rows:
        whole = (" " + (text or "")).encode()
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        bytes_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append(None)
            continue
        spans = []
        for tokens in (bytes_a, bytes_b):
            at, side = 0, []
            for t in tokens:
                side.append((at, at + len(t)))
                at += len(t)
            spans.append(side)
        links, start = [], 0
        for i, (x, y) in enumerate(spans[0]):
            while spans[1][start][1] <= x:
                start += 1
            for j in range(start, len(spans[1])):
                if spans[1][j][0] >= y:
                    break
                links.append((ids_a[i], ids_b[j]))
        common = {y for _, y in spans[0]} & {y for _, y in spans[1]}
        groups = []
        for side, ids in zip(spans, (ids_a, ids_b), strict=True):
            parts, part = [], []
            for (_, y), i in zip(side, ids, strict=True):
                part.append(str(i))
                if y in common:
                    parts.append(",".join(part))
                    part = []
            groups.append(parts)
        text_of = ";".join(f"{x}|{y}" for x, y in zip(*groups, strict=True))
        found.append((len(ids_a), len(ids_b), len(common), links, text_of))
        count.update(set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (i, _), f in zip(rows, found, strict=True):
        if f is None:
            out.append((i, *NOTHING))
            continue
        n_best = sum(count[link] == best[link[0]] for link in f[3])
        total = sum(count[link] for link in f[3])
        out.append((i, f[0], f[1], f[2], len(f[3]), n_best, total, hashlib.sha256(f[4].encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    schema = "doc_id long, text string, text_key string, pairs long, block string, weight string"
    return spark.createDataFrame([(i, t, "k", 1, "b", "w") for i, t in rows], schema)


def aligned(docs):
    return sorted((tuple(r) for r in alignment.align(docs, A, B).collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = QUERIES["op12_token_alignment"](spark, SF_DIR)
    assert got.columns[0] == "doc_id"
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_hand(rows)


ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b ", "\ta\n b\r\n", "x ▁ y", "▁", "é é", "日本 語", "<|endoftext|> <s> </s>",
    "x  y　 z", "​﻿ a", "it's they've", "\x00 \x01", "🙂 🙂🏽", "a" * 5000, "word " * 3000, "<0x0A> x",
]


def test_odd_and_repeated_texts(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "a  b "), (3, "word word"), (3, "word word"), (90, "a  b ")]
    assert aligned(frame(spark, rows)) == by_hand(rows)


@pytest.mark.parametrize("block", [200, 4_000_000])
def test_random_texts_in_blocks_of_any_size(spark, block, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(alignment, "KNOWN_PIECES", 50)
    chance = random.Random(5)
    letters = list("aab cdeE  \n\t.,'é日  \u0085 🙂▁x1<>|") + [" the", " of", "ing "]
    rows = [(k, "".join(chance.choices(letters, k=chance.randrange(60)))) for k in range(300)]
    assert aligned(frame(spark, rows)) == by_hand(rows)


def test_no_rows(spark):
    assert alignment.align(frame(spark, []), A, B).count() == 0
