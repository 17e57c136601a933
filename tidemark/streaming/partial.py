"""Files that carry parts of a period, added up by a stateful stream as they arrive."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.operators.states import Measures, finished, partial_states
from tidemark.sinks.tables import Warehouse
from tidemark.sources.files import CORRUPT, LINEAGE, lineage_column, without_rejects

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Added:
    """Batches of one run, and states that came after their period was closed and were refused."""

    batches: int
    refused: int


def add_up_files(
    spark: SparkSession,
    directory: str,
    schema: StructType | str,
    checkpoint: str,
    warehouse: Warehouse,
    table: str,
    *,
    time: Column | str,
    span: str,
    delay: str,
    measures: Measures,
    period: tuple[str, Column],
    keys: Mapping[str, Column] | None = None,
    multi_line: bool = True,
    max_files: int = 1000,
) -> Added:
    """Add all JSON files not seen before to the aggregates of their periods, and stop.

    A period is ``span`` long (``1 hour``, ``1 day``) and has one row in the table per value of ``keys``.
    Its rows may be spread over any number of files and runs: the partial states live in the
    checkpoint, and each batch upserts the aggregates that changed, so a batch that is replayed changes
    nothing. ``period`` names the table's column for the period and gives it as an expression over
    ``start``, the beginning of the period.

    A period is closed, and its state forgotten, when a row has come that is more than ``delay`` later than its
    end. What comes for a closed period is refused, counted and logged; nothing that is in the table
    is lost by it. A row without a time and a record that is no JSON raise before their batch is
    loaded. Files with equal content are different files and count each.
    """
    fields = spark.createDataFrame([], schema).schema
    rows = (
        spark.readStream.schema(StructType([*fields.fields]).add(CORRUPT, StringType()))
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", max_files)
        .json(directory)
        .select("*", lineage_column())
    )
    good = without_rejects(rows, F.col(CORRUPT).isNotNull(), None)
    at = F.col(time) if isinstance(time, str) else time
    told = F.concat(F.lit("row without a time in "), F.col(LINEAGE))
    timed = good.withColumn("_at", F.coalesce(at.cast("timestamp"), F.raise_error(told).cast("timestamp")))
    timed = timed.withColumns({f"_k_{name}": key for name, key in (keys or {}).items()})
    names = [f"_k_{name}" for name in keys or {}]
    windowed = timed.withWatermark("_at", delay).withColumn("_window", F.window("_at", span))
    states = partial_states(windowed, ["_window", *names], measures)
    batches = 0

    def load(batch: DataFrame, _: int) -> None:
        nonlocal batches
        batches += 1
        done = finished(batch, ["_window", *names], measures).withColumn("start", F.col("_window.start"))
        columns = [period[1].alias(period[0]), *(F.col(f"_k_{name}").alias(name) for name in keys or {})]
        warehouse.upsert(done.select(*columns, *measures), table, reject_null_keys=True)

    query = (
        states.writeStream.outputMode("update")
        .foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    refused: dict[int, int] = {}
    running = True
    while running:
        running = not query.awaitTermination(1)
        for progress in query.recentProgress:
            refused[progress["batchId"]] = sum(o["numRowsDroppedByWatermark"] for o in progress["stateOperators"])
    late = sum(refused.values())
    if late:
        log.warning("%s states came after their period was closed and are not in %s", late, table)
    return Added(batches, late)
