from __future__ import annotations

import os

import pytest

from tidemark.operators.quality import Check
from tidemark.plans.jobs import batch_load, refresh_jobs
from tidemark.session import run_together, scratch_scope, shared_root, stored


def left(spark):
    """Stored frames under the shared folder."""
    root = f"{shared_root(spark)}/tidemark"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_a_scope_deletes_what_was_stored_inside(spark):
    outside = stored(spark.range(3), "kept")
    before = left(spark)
    with scratch_scope(spark):
        stored(spark.range(4), "gone")
        with scratch_scope(spark):
            inner = stored(spark.range(5), "gone")
        assert inner.count() == 5
        run_together([lambda: stored(spark.range(6), "gone").count()] * 3)
        assert len(left(spark)) == len(before) + 5
    assert left(spark) == before and outside.count() == 3


def test_a_scope_deletes_after_a_failure(spark):
    before = left(spark)
    with pytest.raises(KeyError), scratch_scope(spark):
        stored(spark.range(4), "gone")
        raise KeyError
    assert left(spark) == before


def test_jobs_leave_no_stored_frames(spark, warehouse, tmp_path, rows):
    before = left(spark)
    for k, header in enumerate(("a;b", "b;c")):
        (tmp_path / f"{k}.csv").write_text(f"{header}\n1;2\n3;4;5\n")
    assert batch_load(warehouse, str(tmp_path), "csv", "raw.loaded", rejects=str(tmp_path / "rejects")) == 2
    bronze = tmp_path / "bronze"
    jobs = refresh_jobs(
        str(bronze),
        {"raw.raw_parlamento_deputados": [Check("not_null", "id")]},
        schemas={"raw.raw_parlamento_deputados": "id int, name string"},
        multi_line=False,
    )
    job = jobs["raw.raw_parlamento_deputados"]
    path = bronze / "camara" / "deputados"
    path.mkdir(parents=True)
    (path / "parlamento_deputados.csv").write_text("id;name\n1;a\n2;b\n")
    assert job.run(warehouse) == 2
    assert warehouse.read("raw.raw_parlamento_deputados").dtypes == [("id", "int"), ("name", "string")]
    assert left(spark) == before
