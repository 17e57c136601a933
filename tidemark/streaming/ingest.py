"""Files loaded as they arrive, once each, into keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.operators.merge import latest_per_key
from tidemark.session import scratch_scope, stored
from tidemark.sinks.tables import Warehouse
from tidemark.sources.files import CORRUPT, LINEAGE, lineage_column, without_rejects

Derive = Callable[[DataFrame], DataFrame]


def ingest_files(
    spark: SparkSession,
    directory: str,
    schema: StructType | str,
    checkpoint: str,
    warehouse: Warehouse,
    derive: Mapping[str, Derive],
    *,
    archive: str | None = None,
    order_by: Sequence[str] = (),
    multi_line: bool = True,
    max_files: int = 1000,
    rejects: str | None = None,
) -> int:
    """Load all JSON files not seen before and stop; returns the number of batches.

    ``derive`` maps each target table to the plan that turns a batch of documents into its rows.
    The checkpoint records which files are done. A batch that is replayed after a failure upserts
    the same keys again, so it changes nothing; a NULL key would be added again and is refused.
    Each file must carry whole keys, since an upsert replaces rows. A key in two files of one batch
    raises, unless ``order_by`` names the columns that tell which row is the later one; the targets
    have these columns too, so an older file that comes in a later batch changes nothing.

    A record that is no JSON stops the stream before its batch is loaded, or goes to the ``rejects``
    folder. With ``archive``, a file that is done is moved there by the stream.
    """
    fields = spark.createDataFrame([], schema).schema
    reader = (
        spark.readStream.schema(StructType([*fields.fields]).add(CORRUPT, StringType()))
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", max_files)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    batches = 0

    def load(batch: DataFrame, _: int) -> None:
        nonlocal batches
        batches += 1
        with scratch_scope(spark):
            load_batch(batch)

    def load_batch(batch: DataFrame) -> None:
        # Parsed once; every table reads the copy.
        copy = stored(batch, "batch")
        good = without_rejects(copy, F.col(CORRUPT).isNotNull(), rejects).drop(LINEAGE)
        for table, rows_of in derive.items():
            rows = rows_of(good)
            if order_by:
                rows = latest_per_key(rows, warehouse.key(table), order_by)
                rows = _not_older(rows, warehouse, table, order_by)
            warehouse.upsert(rows, table, reject_null_keys=True)

    query = (
        reader.json(directory)
        .select("*", lineage_column())
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return batches


def _not_older(
    rows: DataFrame, warehouse: Warehouse, table: str, order_by: Sequence[str]
) -> DataFrame:
    """Rows that the table does not hold in a later state already."""
    held = warehouse.read(table)
    absent = [c for c in order_by if c not in held.columns]
    if absent:
        raise ValueError(f"{table} lacks the order columns {absent}")
    # In the table's own types, so that both sides compare alike.
    order = [F.col(f"`{c}`").cast(held.schema[c].dataType) for c in order_by]
    key = warehouse.key(table)
    seen = held.select(
        *[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(key)],
        F.struct(*[F.col(f"`{c}`") for c in order_by]).alias("_seen"),
    )
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"_key_{i}") for i, k in enumerate(key)])
    joined = rows.withColumn("_order", F.struct(*order)).join(seen, same, "left")
    fresh = F.col("_seen").isNull() | (F.col("_order") >= F.col("_seen"))
    return joined.where(fresh).select(*[F.col(f"`{c}`") for c in rows.columns])
