from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.streaming.partial import add_up_files


@pytest.fixture
def meter(spark, warehouse, tmp_path):
    """Delivers files of readings and adds them up."""
    warehouse.create_table("raw.hours", "hour string, site string, n bigint, total double, mean double", key=["hour", "site"])
    landing = tmp_path / "landing"
    landing.mkdir()
    sent = 0

    def deliver(*files, max_files=1000):
        nonlocal sent
        for rows in files:
            sent += 1
            text = rows if isinstance(rows, str) else json.dumps([dict(zip(("ts", "site", "v"), r, strict=True)) for r in rows])
            (landing / f"{sent}.json").write_text(text)
        return add_up_files(
            spark,
            str(landing),
            "ts timestamp_ntz, site string, v double",
            str(tmp_path / "checkpoint"),
            warehouse,
            "raw.hours",
            time="ts",
            span="1 hour",
            delay="3 hours",
            measures={"n": ("count", "v"), "total": ("sum", "v"), "mean": ("avg", "v")},
            period=("hour", F.date_format("start", "dd HH")),
            keys={"site": F.coalesce("site", F.lit("?"))},
            max_files=max_files,
        )

    deliver.table = lambda: warehouse.read("raw.hours")
    return deliver


def at(hour, minute=0):
    return f"2024-01-01T{hour:02d}:{minute:02d}:00"


def test_an_hour_in_several_files_and_runs(meter, rows):
    added = meter([(at(1), "a", 1.0), (at(1, 59), "a", 2.0)], [(at(1, 30), "a", 4.0), (at(2), None, 1.0)], max_files=1)
    assert added.refused == 0 and added.batches >= 2
    assert rows(meter.table()) == [("01 01", "a", 3, 7.0, 7 / 3), ("01 02", "?", 1, 1.0, 1.0)]
    meter([(at(1, 5), "a", None), (at(1, 6), "b", 3.0), (at(4), "a", 5.0)])
    assert rows(meter.table()) == [
        ("01 01", "a", 3, 7.0, 7 / 3), ("01 01", "b", 1, 3.0, 3.0), ("01 02", "?", 1, 1.0, 1.0), ("01 04", "a", 1, 5.0, 5.0),
    ]
    assert meter().batches == 0


def test_late_files(meter, rows):
    meter([(at(1), "a", 1.0)], [(at(4), "a", 1.0)])
    # Within the delay: added. After it: refused, and what is there stays.
    assert meter([(at(1, 10), "a", 10.0)]).refused == 0
    meter([(at(9), "a", 1.0)])
    assert meter([(at(1, 20), "a", 100.0), (at(8), "a", 8.0)]).refused == 1
    assert rows(meter.table(), "hour", "total") == [("01 01", 11.0), ("01 04", 1.0), ("01 08", 8.0), ("01 09", 1.0)]


def test_rows_that_cannot_be_placed_raise(meter):
    with pytest.raises(Exception, match="row without a time in 1.json"):
        meter([(None, "a", 1.0)])
    assert meter.table().count() == 0


def test_records_that_are_no_json_raise(meter):
    with pytest.raises(Exception, match="bad record in 1.json"):
        meter("{bad")
