"""Session defaults and the shared folder that intermediate tables live in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

# Settings for tests and the benchmark. On a cluster the session is given.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session; the shuffle width follows the core count."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
    settings = dict(LOCAL_CONF)
    settings["spark.sql.shuffle.partitions"] = "8" if cores == "*" else str(cores)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can see, as the cluster names it.

    ``spark.checkpoint.dir`` wins, then a checkpoint folder set on the context.
    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read again.

    The lineage ends here, so a lost executor costs later steps no more than a re-read. Spark drops
    the shuffle files of the write as soon as it is done: nothing refers to them any more.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    held = _held.get()
    if held is not None:
        held.append(path)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


# The stored frames of the scope that is open, if one is.
_held: ContextVar[list[str] | None] = ContextVar("tidemark_stored", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Frames stored inside are deleted at the end, also after a failure.

    For work whose result is published or counted, so that nothing reads its stored frames any more.
    Inside another scope the outer one deletes.
    """
    if _held.get() is not None:
        yield
        return
    held: list[str] = []
    token = _held.set(held)
    try:
        yield
    finally:
        _held.reset(token)
        path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in held:
            folder = path_of(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def run_together(steps: Sequence[Callable[[], object]], at_once: int = 4) -> list:
    """Results of independent steps, each submitting its own Spark jobs. All are tried; then the
    first failure, if any, is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        # Each thread has a context of its own with the scope of the caller.
        started = [pool.submit(copy_context().run, step) for step in steps]
    return [future.result() for future in started]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
