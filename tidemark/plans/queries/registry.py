"""Registration of queries and the working area they write to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_dir
from tidemark.sinks.tables import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with SQL that gives the same rows."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def working_area(spark: SparkSession) -> Iterator[Warehouse]:
    """A warehouse in a fresh shared folder, under a namespace of its own. Files and catalog entries
    stay for the returned DataFrame to read."""
    name = uuid.uuid4().hex[:12]
    yield Warehouse(spark, scratch_dir(spark, "run"), namespace=f"run_{name}")
