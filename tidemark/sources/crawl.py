"""A work-list of requests, fetched in parallel and landed as document rows."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.functions import fill_template

Fetch = Callable[[str], str]

# The error of a request whose template had a NULL value; it is not sent.
NO_URL = "ValueError: the request has no URL"
# The landing's own column: which run a document came with. Later runs have greater names.
RUN = "landed_run"
# Requests that a task has answers of at a time, per thread.
SLICE = 8


def with_requests(worklist: DataFrame, url: str, file_name: str) -> DataFrame:
    """``url`` and ``file_name`` columns filled from the work-list's own columns."""
    return worklist.withColumns(
        {"url": fill_template(url), "file_name": fill_template(file_name)}
    )


def _answer(fetch: Fetch, url: str | None) -> tuple[str | None, str | None]:
    if url is None:
        return None, NO_URL
    try:
        return fetch(url), None
    except Exception as error:  # noqa: BLE001 - any failure of one request stays with its row
        return None, f"{type(error).__name__}: {error}"


def _fetch_batch(
    fetch: Fetch, urls: list[str], pool: ThreadPoolExecutor, attempts: int, wait: float
) -> list[tuple[str | None, str | None]]:
    """Answers in the order of ``urls``. Failures are asked again together, so the growing waits
    are paid once per round and not once per URL."""
    answers = list(pool.map(lambda url: _answer(fetch, url), urls))
    for attempt in range(1, attempts):
        failed = [i for i, (_, error) in enumerate(answers) if error not in (None, NO_URL)]
        if not failed:
            break
        time.sleep(wait * 2 ** (attempt - 1))
        again = pool.map(lambda i: _answer(fetch, urls[i]), failed)
        for i, answer in zip(failed, list(again)):
            answers[i] = answer
    return answers


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, max(batch.num_rows, 1), rows):
            yield batch.slice(at, rows)


def _paced(fetch: Fetch, pace: float) -> Fetch:
    """``fetch`` with so many seconds between the starts of two requests to a host."""
    lock, due = threading.Lock(), {}

    def later(url: str) -> str:
        host = urlsplit(url).netloc
        with lock:
            start = max(time.monotonic(), due.get(host, 0.0))
            due[host] = start + pace
        time.sleep(max(0.0, start - time.monotonic()))
        return fetch(url)

    return later


def fetch_documents(
    requests: DataFrame,
    open_client: Callable[[], Fetch],
    *,
    parallelism: int,
    in_flight: int = 8,
    attempts: int = 3,
    wait: float = 0.5,
    pace: float = 0.0,
) -> DataFrame:
    """``body`` and ``error`` for every request row.

    ``open_client`` runs once per task and returns the fetch function, so a connection is shared by
    the task's requests; the function is called from ``in_flight`` threads. ``parallelism`` bounds
    the tasks, and with ``in_flight`` the load on the remote side; requests are dealt out evenly,
    also where one URL repeats. A request that keeps failing, or has no URL, has its error in the
    row and does not stop the others. The work-list's own columns pass through unchanged.

    With ``pace`` the requests of one host are dealt to one task, which leaves so many seconds between
    the starts of any two. A task holds the bodies of a few requests per thread at a time.
    """
    schema = StructType(
        requests.schema.fields
    ).add("body", StringType()).add("error", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = _paced(open_client(), pace) if pace else open_client()
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in _slices(batches, SLICE * in_flight):
                done = _fetch_batch(fetch, batch.column("url").to_pylist(), pool, attempts, wait)
                answers = [pa.array(list(column), pa.string()) for column in zip(*done)] or [pa.array([], pa.string())] * 2
                names = [*batch.schema.names, "body", "error"]
                yield pa.RecordBatch.from_arrays([*batch.columns, *answers], names=names)

    host = F.coalesce(F.parse_url("url", F.lit("HOST")), F.lit(""))
    dealt = requests.repartition(parallelism, host) if pace else requests.repartition(parallelism)
    return dealt.mapInArrow(run, schema)


def aside_of(path: str, run: str) -> str:
    """The folder beside a landing that holds all rows of a run, failed ones included."""
    return f"{path.rstrip('/')}__runs/{run}"


def land_documents(
    documents: DataFrame, path: str, partition_by: str | None = None, run: str | None = None, add: bool = True
) -> DataFrame:
    """Add fetched documents to a landing; returns this run's rows, the failed ones included.

    The rows are written once, beside the landing, so no later step fetches again; there the failed
    requests stay with their errors. The documents that came are then added to the landing, and
    nothing that was landed before is touched. ``read_landed`` takes the last of each file name. A
    ``run`` that is named can be tried again after a failure; later runs must have greater names.
    Without ``add`` the rows only stand beside the landing, until ``add_runs``.
    """
    spark = documents.sparkSession
    run = run or f"{time.time_ns():020d}-{uuid.uuid4().hex[:6]}"
    aside = aside_of(path, run)
    documents.write.mode("overwrite").parquet(aside)
    if add:
        add_runs(spark, path, documents.schema, [run], partition_by)
    return spark.read.schema(documents.schema).parquet(aside)


def add_runs(
    spark: SparkSession, path: str, schema: StructType, runs: list[str], partition_by: str | None = None
) -> None:
    """Add the documents of runs that stand beside a landing to it, in one write."""
    fetched = spark.read.schema(schema).parquet(*(aside_of(path, run) for run in runs))
    # The folder that a row stands in has the name of its run.
    run = F.lit(runs[0]) if len(runs) == 1 else F.element_at(F.split("_metadata.file_path", "/"), -2)
    writer = fetched.where("error IS NULL").withColumn(RUN, run).drop("error").write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_landed(
    spark: SparkSession, path: str, schema: StructType | str, partition_by: str | None = None
) -> DataFrame:
    """The landed documents, one of each file name (in each partition): that of the last run.

    Only names and runs are grouped; the bodies are joined to the winners. Nothing landed gives no
    rows. The partition column has its declared type instead of one guessed from directory names.
    """
    fields = spark.createDataFrame([], schema).schema
    try:
        rows = spark.read.schema(StructType([*fields.fields]).add(RUN, StringType())).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields)
    key = ["file_name", *([partition_by] if partition_by else [])]
    last = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.max(RUN).alias("_run"))
    same = F.col(RUN) == F.col("_run")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(last, same, "left_semi").select(*[f.name for f in fields.fields])


def parameter_ids(ids: DataFrame, column: str) -> DataFrame:
    """The distinct ids of a parameter table; blanks are dropped."""
    return ids.select(column).where(F.col(column).isNotNull()).distinct()


def single_request(spark: SparkSession, url: str, file_name: str) -> DataFrame:
    """A one-row work-list, for sources that are one document."""
    return spark.range(1).select(F.lit(url).alias("url"), F.lit(file_name).alias("file_name"))


def days_to_requests(days: DataFrame, url: str, file_name: str) -> DataFrame:
    """One request per missing day; the templates use ``{date}``."""
    dated = days.select(F.col("day").cast("string").alias("date"))
    return with_requests(dated, url, file_name)
