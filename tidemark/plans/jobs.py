"""Whole jobs: configured compositions of sources, checks, operators and sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.merge import union_by_name
from tidemark.operators.quality import Check, require_valid
from tidemark.session import run_together, scratch_scope, stored
from tidemark.sinks.archive import archive_documents
from tidemark.plans.catalog import KEYED_PARTITIONS, KEYED_TABLES, REFRESH_TABLES
from tidemark.sinks.export import export_all, export_csv
from tidemark.sinks.tables import How, Warehouse
from tidemark.sources.crawl import (
    Fetch,
    fetch_documents,
    land_documents,
    parameter_ids,
    with_requests,
)
from tidemark.sources.files import (
    LINEAGE,
    read_csv_dir,
    read_json_dir,
    read_text_csv,
    read_typed_csv,
)

log = logging.getLogger(__name__)

Step = Callable[[DataFrame], DataFrame]

# Versions of a table that a job leaves for readers that still hold them.
KEEP_VERSIONS = 8


@dataclass(frozen=True)
class JobConfig:
    """Where a job reads and writes. An unknown setting is refused.

    ``crawl_job`` and ``parameter_worklist`` take ``url_base``, a URL template, the landing and the
    parameter file from here; ``RefreshJob`` takes the bronze file.
    """

    db_table: str
    url_base: str | None = None
    landing_dir: str | None = None
    landing_file: str | None = None
    bronze_dir: str | None = None
    bronze_file: str | None = None
    parameter_file: str | None = None

    @property
    def bronze_path(self) -> str:
        return f"{self.bronze_dir.rstrip('/')}/{self.bronze_file}"


def _same(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class RefreshJob:
    """Extract, transform, check, then replace the target as a whole.

    ``extract`` left out reads the bronze CSV; ``transform`` left out keeps the rows; ``load`` left
    out is the gated refresh.
    """

    config: JobConfig
    target: str
    extract: Callable[[SparkSession, JobConfig], DataFrame] | None = None
    transform: Step | None = None
    checks: Sequence[Check] = ()
    load: Callable[[DataFrame, Warehouse, str], int] | None = None
    # Of the bronze CSV: with a schema no pass finds types; without line breaks in cells it is split.
    schema: str | None = None
    multi_line: bool = True
    rejects: str | None = None
    keep_versions: int = KEEP_VERSIONS

    def staging(self, spark: SparkSession) -> DataFrame:
        if self.extract:
            rows = self.extract(spark, self.config)
        else:
            rows = read_typed_csv(
                spark,
                self.config.bronze_path,
                self.schema,
                multi_line=self.multi_line,
                rejects=self.rejects,
            )
        return rows.transform(self.transform or _same)

    def run(self, warehouse: Warehouse) -> int:
        with scratch_scope(warehouse.spark):
            return self._run(warehouse)

    def _run(self, warehouse: Warehouse) -> int:
        staging = self.staging(warehouse.spark)
        if self.checks:
            # Parsed once: the checks, each on its own columns, and the load read the copy.
            staging = stored(staging, "staging")
            require_valid(staging, self.checks)
        if self.load:
            return self.load(staging, warehouse, self.target)
        rows = warehouse.refresh(staging, self.target)
        warehouse.expire(self.target, self.keep_versions)
        return rows


def refresh_jobs(
    bronze_root: str,
    checks: Mapping[str, Sequence[Check]] | None = None,
    *,
    schemas: Mapping[str, str] | None = None,
    multi_line: bool = True,
    rejects: str | None = None,
) -> dict[str, RefreshJob]:
    """The full-refresh jobs of the catalog by target table, with the checks and schemas given per target.

    A target with a schema is read without a pass that finds types; ``multi_line=False``, for files without
    line breaks in cells, lets one file be read by many tasks.
    """
    jobs = {}
    for staging, target, path in REFRESH_TABLES:
        folder, _, name = path.rpartition("/")
        config = JobConfig(
            db_table=staging, bronze_dir=f"{bronze_root.rstrip('/')}/{folder}", bronze_file=name
        )
        jobs[target] = RefreshJob(
            config,
            target,
            checks=(checks or {}).get(target, ()),
            schema=(schemas or {}).get(target),
            multi_line=multi_line,
            rejects=rejects,
        )
    return jobs


@dataclass(frozen=True)
class IncrementalJob:
    """Find what is missing, get its documents, derive rows per table, upsert, archive.

    ``worklist`` gives the missing dates; ``extract`` turns them into landed documents, and it must
    return a written table because every target reads it. ``derive`` has one plan per keyed target.
    Archived columns are ``file_name, content``.
    """

    worklist: Callable[[Warehouse], DataFrame]
    extract: Callable[[DataFrame], DataFrame]
    derive: Mapping[str, Step]
    archive_table: str | None = None
    to_archive: Step = _same
    keep_versions: int = KEEP_VERSIONS

    def run(self, warehouse: Warehouse) -> bool:
        """False when nothing was missing and no step ran."""
        with scratch_scope(warehouse.spark):
            return self._run(warehouse)

    def _run(self, warehouse: Warehouse) -> bool:
        missing = self.worklist(warehouse)
        if missing.isEmpty():
            log.info("nothing is missing, skipped")
            return False
        documents = self.extract(missing)
        if self.archive_table:
            # Kept before anything is derived, so a failed run can be rebuilt.
            archive_documents(self.to_archive(documents), warehouse, self.archive_table)
        self.publish(documents, warehouse)
        return True

    def publish(self, documents: DataFrame, warehouse: Warehouse) -> None:
        """Upsert every target; also the whole of a rebuild from archived documents."""

        def upsert(table: str, rows_of: Step) -> None:
            # The table's own types, text as a rule, are applied on the way in.
            warehouse.upsert(rows_of(documents), table)
            warehouse.expire(table, self.keep_versions)

        run_together([partial(upsert, table, rows_of) for table, rows_of in self.derive.items()])


@dataclass(frozen=True)
class CrawlJob:
    """Fetch one document per work-list row, land them, load the good ones into a raw table."""

    url: str
    file_name: str
    target: str
    open_client: Callable[[], Fetch]
    load_documents: Step = _same
    parallelism: int = 8
    attempts: int = 3
    wait: float = 0.5
    partition_by: str | None = None
    how: How = "append"

    def run(self, worklist: DataFrame, warehouse: Warehouse, landing: str) -> DataFrame:
        """Returns the requests that failed, with their error; if all did, nothing is loaded."""
        requests = with_requests(worklist, self.url, self.file_name)
        fetched = fetch_documents(
            requests,
            self.open_client,
            parallelism=self.parallelism,
            attempts=self.attempts,
            wait=self.wait,
        )
        landed = land_documents(fetched, landing, self.partition_by)
        good = landed.where(landed["error"].isNull())
        if not good.isEmpty():
            warehouse.load(self.load_documents(good), self.target, self.how)
        return landed.where(landed["error"].isNotNull())


def crawl_job(config: JobConfig, open_client: Callable[[], Fetch], **options) -> CrawlJob:
    """The crawl that a configuration describes: URL and file name templates and the raw table."""
    return CrawlJob(config.url_base, config.landing_file, config.db_table, open_client, **options)


def parameter_worklist(spark: SparkSession, config: JobConfig, column: str, separator: str = ";") -> DataFrame:
    """The distinct ids in a column of the configuration's parameter file."""
    return parameter_ids(read_text_csv(spark, config.parameter_file, separator), column)


def read_landing(
    spark: SparkSession,
    directory: str,
    file_type: str,
    separator: str = ";",
    *,
    multi_line: bool,
    schema: str | None = None,
    rejects: str | None = None,
) -> DataFrame | None:
    """All files of one type in a directory, with the file name; None without files.

    A declared ``schema`` saves the pass that finds types.
    """
    options = {"schema": schema, "multi_line": multi_line, "rejects": rejects}
    if file_type == "csv":
        return read_csv_dir(spark, directory, separator, **options)
    if file_type == "json":
        return read_json_dir(spark, directory, **options)
    raise ValueError(f"unknown file type {file_type!r}")


def consolidate(
    spark: SparkSession,
    directory: str,
    file_type: str,
    path: str,
    *,
    separator: str = ";",
    unique: bool = False,
    multi_line: bool = True,
    schema: str | None = None,
    rejects: str | None = None,
) -> str | None:
    """Dated landing files as one CSV data set; ``unique`` drops rows that repeat as a whole."""
    with scratch_scope(spark):
        rows = read_landing(
            spark, directory, file_type, separator, multi_line=multi_line, schema=schema, rejects=rejects
        )
        if rows is None:
            return None
        rows = rows.drop(LINEAGE)
        return export_csv(rows.distinct() if unique else rows, path, separator)


def batch_load(
    warehouse: Warehouse,
    directory: str,
    file_type: str,
    table: str,
    *,
    separator: str = ";",
    how: How = "replace",
    multi_line: bool = True,
    schema: str | None = None,
    rejects: str | None = None,
) -> int | None:
    """All files of a directory into one table, with the file name; None and no change without
    files."""
    spark = warehouse.spark
    with scratch_scope(spark):
        rows = read_landing(
            spark, directory, file_type, separator, multi_line=multi_line, schema=schema, rejects=rejects
        )
        if rows is None:
            return None
        loaded = warehouse.load(rows, table, how)
    log.info("%s rows loaded into %s", loaded, table)
    return loaded


@dataclass(frozen=True)
class MartRefresh:
    """Marts by tag. Each is a plan over published tables and is published by full refresh."""

    marts: Mapping[str, Callable[[Warehouse], DataFrame]]
    tags: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def run(self, warehouse: Warehouse, tag: str | None = None) -> dict[str, int]:
        """Rows per refreshed mart; without a tag all are refreshed."""
        if tag is not None and tag not in self.tags:
            raise ValueError(f"unknown tag {tag!r}")
        names = list(self.marts) if tag is None else self.tags[tag]
        refresh = [lambda n=n: warehouse.refresh(self.marts[n](warehouse), n) for n in names]
        with scratch_scope(warehouse.spark):
            return dict(zip(names, run_together(refresh)))

    def export(self, warehouse: Warehouse, directory: str, **options) -> DataFrame:
        tables = {n.split(".")[1]: (lambda n=n: warehouse.read(n)) for n in self.marts}
        return export_all(warehouse.spark, tables, directory, **options)


@dataclass(frozen=True)
class Stage:
    """A crawl whose work-list is a query over what earlier stages published."""

    job: CrawlJob
    worklist: Callable[[Warehouse], DataFrame]
    landing: str


@dataclass(frozen=True)
class ModelStage:
    """Models refreshed between crawls, so that the next work-lists read fresh ones."""

    refresh: MartRefresh
    tag: str | None = None


def staged_crawl(warehouse: Warehouse, stages: Sequence[Stage | ModelStage]) -> DataFrame:
    """Run the stages in order; returns the failed requests with their error.

    A work-list is evaluated when its stage starts, so it sees the tables, and the models, of the
    stages before. A failed request stays pending and is asked again by the next run.
    """
    failed = []
    for stage in stages:
        if isinstance(stage, ModelStage):
            stage.refresh.run(warehouse, stage.tag)
            continue
        rows = stage.job.run(stage.worklist(warehouse), warehouse, stage.landing)
        failed.append(rows.select("url", "error"))
    return union_by_name(failed)


def create_keyed(warehouse: Warehouse, table: str) -> None:
    """A keyed table of the catalog with its partitions, if it is absent."""
    columns, key = KEYED_TABLES[table]
    warehouse.create_table(table, columns, key=key, partition=KEYED_PARTITIONS[table])
