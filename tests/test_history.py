from __future__ import annotations

import random

import pytest

from tidemark.operators.history import as_of, validity_intervals
from tidemark.operators.worklist import (
    flags_by_bitmap,
    id_bitmaps,
    merged_bitmaps,
    pending_by_bitmap,
    pending_ids,
    request_flags,
)


def intervals_by_hand(rows):
    """(key, state, from, to, snapshots) of (key, day, state) rows."""
    days = sorted({d for _, d, _ in rows})
    out = []
    for key, state in {(k, s) for k, _, s in rows}:
        mine = {d for k, d, s in rows if (k, s) == (key, state)}
        start = None
        for at, d in enumerate([*days, None]):
            if d in mine and start is None:
                start = at
            if d not in mine and start is not None:
                out.append((key, state, days[start], d, at - start))
                start = None
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_intervals(spark, rows, seed):
    chance = random.Random(seed)
    given = [(chance.choice("ab"), f"2024-01-{chance.randrange(1, 15):02d}", chance.choice("xy")) for _ in range(60)]
    df = spark.createDataFrame(given + [("a", None, "x")], "k string, day string, state string")
    found = sorted((tuple(r) for r in validity_intervals(df, ["k"], "day", ["state"]).collect()), key=str)
    assert found == intervals_by_hand(given)


def test_facts_meet_the_interval_they_fall_in(spark, rows):
    given = [("a", "01", "x"), ("a", "03", "x"), ("a", "05", "y"), ("b", "05", "x"), ("b", "07", "x")]
    intervals = validity_intervals(spark.createDataFrame(given, "k string, day string, s string"), ["k"], "day", ["s"])
    votes = spark.createDataFrame([("a", "00"), ("a", "02"), ("a", "04"), ("a", "05"), ("a", "07"), ("b", "09"), ("c", "05")], "k string, at string")
    found = rows(as_of(votes, intervals, ["k"], "at"), "k", "at", "s", "valid_from")
    assert found == [
        ("a", "00", None, None), ("a", "02", "x", "01"), ("a", "04", "x", "01"), ("a", "05", "y", "05"), ("a", "07", None, None),
        ("b", "09", "x", "05"), ("c", "05", None, None),
    ]


def test_bitmaps_of_ids(spark, rows):
    chance = random.Random(7)
    ids = [chance.choice([k, -k, k * 40_000, k + 2**33]) for k in range(1, 200) for _ in range(2)] + [0, 32_767, 32_768, 32_769, None]
    wanted = [*{i for i in ids if i is not None and chance.random() < 0.5}, 5_000_000, -5, None, 1, 1]
    loaded = spark.createDataFrame([(i,) for i in ids], "id long")
    entities = spark.createDataFrame([(i, "e") for i in wanted], "key long, _b string")
    bitmaps = merged_bitmaps(id_bitmaps(loaded.where("id % 2 = 0"), "id"), id_bitmaps(loaded.where("id % 2 <> 0"), "id"), id_bitmaps(loaded, "id"))
    assert rows(pending_by_bitmap(entities, "key", bitmaps)) == rows(pending_ids(entities, "key", loaded, "id"))
    by_bitmap = flags_by_bitmap(entities, "key", {"there": bitmaps, "none": bitmaps.limit(0)})
    assert rows(by_bitmap) == rows(request_flags(entities, "key", {"there": (loaded, "id"), "none": (loaded.limit(0), "id")}))
    assert bitmaps.groupBy("bucket").count().where("count > 1").count() == 0
