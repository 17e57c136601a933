"""Column-wise suffix sorting and the byte runs it removes, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import column_wise

WINDOW, ANCHOR = 20, 6


def packed(strings):
    ends = np.cumsum([len(s) for s in strings])
    return np.frombuffer(b"".join(strings), np.uint8), np.concatenate([[0], ends])


@pytest.mark.parametrize("seed", range(60))
def test_suffixes_in_order_with_common_prefixes(seed):
    chance = random.Random(seed)
    letters = chance.choice([b"a", b"ab", b"abcdefgh", bytes(range(256))])
    strings = [bytes(chance.choices(letters, k=chance.randrange(25))) for _ in range(chance.randrange(1, 12))]
    strings += strings[: chance.randrange(3)]
    string, size, common = column_wise.sorted_suffixes(*packed(strings))
    found = [strings[s][len(strings[s]) - n :] for s, n in zip(string, size, strict=True)]
    assert found == sorted(s[k:] for s in strings for k in range(len(s) + 1))
    for k in range(1, len(found)):
        n = 0
        while n < min(len(found[k - 1]), len(found[k])) and found[k - 1][n] == found[k][n]:
            n += 1
        assert common[k] == n


@pytest.mark.parametrize("seed", range(60))
def test_anchors_depend_on_the_window_alone(seed):
    chance = random.Random(seed)
    letters = chance.choice([b"a", b"ab", b"abcdefgh"])
    strings = [bytes(chance.choices(letters, k=chance.randrange(80))) for _ in range(5)]
    data, offsets = packed(strings)
    of_window, seen = {}, []
    for text, value, place, first, n in zip(*column_wise.anchored(data, offsets, WINDOW, ANCHOR), strict=True):
        for at in range(first, first + n):
            window = data[at : at + WINDOW].tobytes()
            assert at <= place <= at + WINDOW - ANCHOR
            assert of_window.setdefault(window, (value, place - at)) == (value, place - at)
            seen.append((text, at - offsets[text]))
    assert sorted(seen) == [(t, i) for t, s in enumerate(strings) for i in range(len(s) - WINDOW + 1)]


def by_hand(rows, window):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - window + 1):
            if i is not None:
                run = data[at : at + window]
                first[run] = min(first.get(run, (i, at)), (i, at))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - window + 1):
            if i is not None and first[data[at : at + window]] < (i, at):
                gone[at : at + window] = True
        spans = int(np.sum(gone[1:] & ~gone[:-1]) + gone[0])
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out.append((i, len(data), int(gone.sum()), spans, kept))
    return sorted(out, key=str)


def frame(spark, rows, kind="long"):
    schema = f"doc_id {kind}, text string, key string, spans long, row string, first long"
    return spark.createDataFrame([(i, t, "k", 1, "r", 2) for i, t in rows], schema)


def found(docs, window=WINDOW, anchor=ANCHOR):
    rows = column_wise.remove_repeated(docs, window, anchor).collect()
    return sorted(
        ((r["row"]["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows), key=str
    )


def texts(seed, n=40):
    chance = random.Random(seed)
    pool = ["".join(chance.choices("abc é日 ", k=chance.randrange(10, 60))) for _ in range(12)]
    rows = [(chance.randrange(30), "".join(chance.choices(pool, k=chance.randrange(5)))) for _ in range(n)]
    rows += [(None, pool[0] * 2), (None, None), (7, None), (8, ""), (9, "x" * 300), (2, "xy" * 100), (9, "x" * 300)]
    return rows + [(31, "x" * (WINDOW - 1)), (32, "x" * WINDOW), (40, "".join(chance.choices("abcdefgh ", k=5000)) * 2)]


# A crowded anchor is one with any bytes at all: all passages are cut into classes, then to windows.
@pytest.mark.parametrize("crowded", [2_000_000, 60, 0])
def test_removed_runs(spark, crowded, monkeypatch):
    monkeypatch.setattr(column_wise, "CROWDED_BYTES", crowded)
    monkeypatch.setattr(column_wise, "PART_BYTES", 700)
    monkeypatch.setattr(column_wise, "COLLECTION_BYTES", 300)
    rows = texts(crowded)
    assert found(frame(spark, rows)) == by_hand(rows, WINDOW)


def test_ids_that_are_text(spark):
    rows = [(None if i is None else f"d{i}", t) for i, t in texts(3)]
    assert found(frame(spark, rows, "string")) == by_hand(rows, WINDOW)


def test_production_window_with_a_common_line(spark):
    chance = random.Random(4)
    line = "".join(chance.choices("abcdefghij ", k=90))
    rows = [(k, "".join(chance.choices("abcdefghij ", k=40)) + line + "".join(chance.choices("klm ", k=60))) for k in range(300)]
    rows += [(300 + k, "z" * k + line + rows[k][1][-20:] + line) for k in range(50)]
    assert found(frame(spark, rows), 100, 32) == by_hand(rows, 100)


def test_no_rows(spark):
    assert column_wise.remove_repeated(frame(spark, [])).count() == 0


def test_windows_that_are_too_long_for_a_collection(spark):
    with pytest.raises(ValueError, match="255"):
        column_wise.remove_repeated(frame(spark, []), 200, 32)
