from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.states import finished, merged_states, partial_states
from tidemark.plans.marts import refresh_by_delta

SCHEMA = "id bigint, day string, kind string, v double"
MEASURES = {"n": ("count", "v"), "total": ("sum", "v"), "least": ("min", "v"), "most": ("max", "v"), "mean": ("avg", "v")}


def by_hand(rows):
    out = {}
    for _, _, kind, v in rows:
        out.setdefault(kind, []).extend([v] if v is not None else [])
    return {k: (len(v), sum(v) if v else None, min(v, default=None), max(v, default=None), sum(v) / len(v) if v else None) for k, v in out.items()}


def result(df):
    return {r["kind"]: (r["n"], r["total"], r["least"], r["most"], r["mean"]) for r in df.collect()}


def some_rows(seed, ids, days):
    chance = random.Random(seed)
    return [(i, chance.choice(days), chance.choice(["a", "b", None]), chance.choice([None, 1.0, 2.5, -4.0])) for i in ids]


def test_states_merge_to_the_aggregates(spark):
    rows = some_rows(1, range(200), ["d1", "d2", None]) + [(900, "d1", "none", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = partial_states(df, ["kind", "day"], MEASURES)
    twice = merged_states(merged_states(parts, ["kind", "day"], MEASURES), ["kind"], MEASURES)
    assert result(finished(twice, ["kind"], MEASURES)) == by_hand(rows)


@pytest.fixture
def readings(warehouse):
    warehouse.create_table("raw.readings", SCHEMA, key=["id", "day"], partition=("part", "day"))
    return warehouse


def refresh(warehouse):
    return refresh_by_delta(warehouse, "raw.readings", "marts.kinds", ["kind"], MEASURES)


def test_a_mart_reads_changed_partitions_only(spark, readings):
    held = {}

    def deliver(rows):
        held.update({(r[0], r[1]): r for r in rows})
        readings.upsert(spark.createDataFrame(rows, SCHEMA), "raw.readings")
        changed = refresh(readings)
        assert result(readings.read("marts.kinds")) == by_hand(held.values())
        return changed

    assert deliver(some_rows(2, range(100), ["d1", "d2", "d3"])) is None
    assert deliver(some_rows(3, range(50, 120), ["d3", "d4"])) == ["d3", "d4"]
    assert deliver([(7, "d1", "new", 5.0)]) == ["d1"]
    assert refresh(readings) == []
    # An append changes its partition; a version that is forgotten costs a full pass.
    readings.load(spark.createDataFrame([(500, "d2", "a", 1.0)], SCHEMA), "raw.readings", "append")
    held[500, "d2"] = (500, "d2", "a", 1.0)
    assert refresh(readings) == ["d2"]
    readings.upsert(spark.createDataFrame([(501, "d9", "a", 2.0)], SCHEMA), "raw.readings")
    held[501, "d9"] = (501, "d9", "a", 2.0)
    readings.expire("raw.readings", keep=1)
    assert refresh(readings) is None
    assert result(readings.read("marts.kinds")) == by_hand(held.values())


def test_a_partition_that_goes_leaves_the_mart(spark, readings):
    readings.upsert(spark.createDataFrame([(1, "d1", "a", 1.0), (2, "d2", "b", 2.0)], SCHEMA), "raw.readings")
    refresh(readings)
    readings.refresh(spark.createDataFrame([(2, "d2", "b", 3.0)], SCHEMA), "raw.readings")
    assert refresh(readings) == ["d1", "d2"]
    assert result(readings.read("marts.kinds")) == {"b": (1, 3.0, 3.0, 3.0, 3.0)}


def test_states_that_were_not_followed_by_a_mart_are_made_good(spark, readings, monkeypatch):
    readings.upsert(spark.createDataFrame([(1, "d1", "a", 1.0)], SCHEMA), "raw.readings")
    refresh(readings)
    readings.upsert(spark.createDataFrame([(1, "d1", "a", 9.0)], SCHEMA), "raw.readings")
    with monkeypatch.context() as broken:
        broken.setattr(type(readings), "load", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(readings)
    assert refresh(readings) == []
    assert result(readings.read("marts.kinds")) == {"a": (1, 9.0, 9.0, 9.0, 9.0)}


def test_a_source_without_partitions(spark, warehouse):
    warehouse.load(spark.range(3), "raw.flat")
    with pytest.raises(ValueError, match="no partitions"):
        refresh_by_delta(warehouse, "raw.flat", "marts.m", ["id"], {"n": ("count", F.lit(1))})
