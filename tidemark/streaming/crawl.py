"""A crawl that goes on where it stopped: the work-list as a stream of small files."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.sources.crawl import RUN, Fetch, add_runs, aside_of, fetch_documents, land_documents

# Batches that are added to the landing and noted in the checkpoint together; each is asked alone.
NOTED_TOGETHER = 16


def queue_requests(requests: DataFrame, queue: str, per_file: int = 500) -> int:
    """Add requests (``url``, ``file_name`` and any columns) to a queue; returns how many.

    The queue is a folder of Parquet files of at most ``per_file`` requests. The files of one call appear
    together, when all are written.
    """
    spark = requests.sparkSession
    path = f"{queue.rstrip('/')}/{time.time_ns():020d}-{uuid.uuid4().hex[:6]}"
    requests.write.option("maxRecordsPerFile", per_file).parquet(path)
    return spark.read.schema(requests.schema).parquet(path).count()


def crawl_queue(
    spark: SparkSession,
    queue: str,
    schema: StructType | str,
    checkpoint: str,
    landing: str,
    open_client: Callable[[], Fetch],
    *,
    parallelism: int,
    files_per_batch: int = 8,
    partition_by: str | None = None,
    **options,
) -> int:
    """Fetch what the queue holds and was not landed yet, batch by batch; returns the batches.

    A batch takes at most ``files_per_batch`` files of the queue and is written down beside the landing
    before the next one is asked, so a run that is lost costs the requests of one batch. A few batches at
    a time are then added to the landing and noted in the checkpoint, also when a later one fails. What
    was written down or landed but not yet noted is found by the batch's name and not asked again.
    Requests that fail stay with their error beside the documents, as in any crawl. ``options`` go to
    ``fetch_documents``.
    """
    fields = spark.createDataFrame([], schema).schema
    answered = StructType([*fields.fields]).add("body", StringType()).add("error", StringType())
    batches = 0
    landed = _landed_runs(spark, landing)
    # Only the first load can have been tried by an earlier run, which then left its plan in the checkpoint.
    tried = _exists(spark, f"{checkpoint.rstrip('/')}/offsets")

    def load(files: DataFrame, number: int) -> None:
        nonlocal batches, tried
        # A queue's folders are named by time, so the order of names is that of the deliveries.
        names = sorted(unquote(r["file_path"]) for r in files.distinct().collect())
        written = []
        try:
            for part, at in enumerate(range(0, max(len(names), 1), files_per_batch)):
                batches += 1
                # The same name whenever this batch is tried, and greater ones for later batches.
                run = f"queue-{number:012d}" + (f"-{part:06d}" if part else "")
                if run in landed:
                    continue
                if not (tried and _exists(spark, f"{aside_of(landing, run)}/_SUCCESS")):
                    some = names[at : at + files_per_batch]
                    # The stream's own frame would read all its files for each batch.
                    reader = spark.read.schema(fields).option("recursiveFileLookup", True)
                    batch = reader.parquet(*some) if some else spark.createDataFrame([], fields)
                    documents = fetch_documents(batch, open_client, parallelism=parallelism, **options)
                    land_documents(documents, landing, partition_by, run, False)
                written.append(run)
        finally:
            if written:
                add_runs(spark, landing, answered, written, partition_by)
        tried = False

    query = (
        spark.readStream.schema(fields)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch * NOTED_TOGETHER)
        .parquet(queue)
        .select("_metadata.file_path")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return batches


def _landed_runs(spark: SparkSession, landing: str) -> set[str]:
    """Names of the batches that a landing has documents of."""
    try:
        rows = spark.read.schema(f"{RUN} string").parquet(landing)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {r[RUN] for r in rows.where(F.col(RUN).startswith("queue-")).distinct().collect()}


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)
