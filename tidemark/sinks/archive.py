"""Keeping loaded documents: an archive table, a manifest, and moving files."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sinks.tables import Warehouse

ARCHIVE_SCHEMA = "key string, file_name string, length bigint, content binary"


def _by_folder(digits: int) -> tuple[str, str]:
    """Keys with a folder of their own below the prefix go by it. Flat keys, all in one folder, are dealt
    by a hash, so that a delivery rewrites the shares it falls into and no share holds everything."""
    return (
        "folder",
        "CASE WHEN key LIKE '%/%/%' THEN regexp_extract(key, '^(.*)/', 1)"
        f" ELSE concat(regexp_extract(key, '^(.*)/', 1), '/', substring(md5(key), 1, {digits})) END",
    )


def archive_documents(
    documents: DataFrame,
    warehouse: Warehouse,
    table: str,
    prefix: str = "bronze/",
    suffix: str = ".json",
    *,
    digits: int = 2,
) -> None:
    """Store ``file_name, content`` rows under ``prefix + file_name``, replacing a key sent again.

    Only names that end in ``suffix``, in that case, are taken. The archive is partitioned by the
    folder part of the key, flat names by a share of their hash, and only partitions that receive a
    document are rewritten; names with a date folder keep a daily delivery from touching older days.
    A new archive has 16 to the power of ``digits`` shares of flat names: choose it so that a share is
    some GB at the size the archive is to reach. ``documents`` is computed once; the key check and the
    write read the copy.
    """
    warehouse.create_table(table, ARCHIVE_SCHEMA, key=["key"], partition=_by_folder(digits))
    rows = documents.where(F.col("file_name").endswith(suffix)).select(
        F.concat(F.lit(prefix), "file_name").alias("key"),
        "file_name",
        F.octet_length("content").cast("long").alias("length"),
        F.col("content").cast("binary").alias("content"),
    )
    warehouse.upsert(rows, table)


def unloaded_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files that the manifest does not name."""
    return files.join(manifest.select("file_name").distinct(), "file_name", "left_anti")


def move_loaded_files(spark: SparkSession, staging: str, bronze: str) -> int:
    """Move ``*.json`` from staging to bronze and delete staging's ``*.csv``.

    Returns the number of files moved. Each step is a rename or a delete in the file system; no
    content passes through here. CSV files go also when there is no JSON file.
    """
    jvm = spark.sparkContext._jvm
    path_of = jvm.org.apache.hadoop.fs.Path
    target = path_of(bronze)
    fs = path_of(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)

    def listed(pattern: str):
        return [s.getPath() for s in fs.globStatus(path_of(f"{staging.rstrip('/')}/{pattern}"))]

    def move(path) -> None:
        destination = path_of(target, path.getName())
        if fs.exists(destination):
            fs.delete(destination, False)
        if not fs.rename(path, destination):
            raise OSError(f"could not move {path}")

    found = listed("*.json")
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, found))
        list(pool.map(lambda p: fs.delete(p, False), listed("*.csv")))
    return len(found)
