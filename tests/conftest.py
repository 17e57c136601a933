from __future__ import annotations

import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tidemark.session import local_session  # noqa: E402
from tidemark.sinks.tables import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        "*",
        **{
            "spark.checkpoint.dir": shared,
            "spark.sql.warehouse.dir": f"{shared}/warehouse",
            # Fixtures are a handful of rows.
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "warehouse"), namespace=f"t_{uuid.uuid4().hex[:8]}")
    yield made
    made.release()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, NULL first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()),
            key=lambda r: [(v is not None, str(v)) for v in r],
        )

    return collect
