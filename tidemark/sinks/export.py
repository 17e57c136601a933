"""CSV exports."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField

from tidemark.session import run_together

REPORT_SCHEMA = "table_name string, n_rows bigint, path string, error string"


class ExportFailed(RuntimeError):
    """At least one table could not be exported; ``report`` tells which."""

    def __init__(self, report: list[tuple]) -> None:
        failed = [f"{name}: {error}" for name, _, _, error in report if error]
        super().__init__("; ".join(failed))
        self.report = report


def _cell(field: StructField) -> Column:
    value = F.col(f"`{field.name}`")
    kind = field.dataType.simpleString()
    if kind == "boolean":
        return F.initcap(value.cast("string")).alias(field.name)
    if kind.startswith("timestamp"):
        # A format would cut or pad the fraction of a second.
        return value.cast("string").alias(field.name)
    return value


def export_csv(df: DataFrame, path: str, separator: str = ";") -> str:
    """Write ``df`` as CSV with a header, replacing what was at ``path``.

    ``path`` becomes a folder of part files, one per task, so the export is not squeezed through one
    writer. NULL and empty text are both empty cells; booleans are ``True`` and ``False``.
    """
    (
        df.select(*[_cell(f) for f in df.schema.fields]).write.mode("overwrite")
        .option("header", True)
        .option("sep", separator)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        # Blanks at the ends of a text belong to it.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def export_query(spark: SparkSession, query: str, path: str, separator: str = ",") -> str:
    return export_csv(spark.sql(query), path, separator)


def export_all(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    directory: str,
    separator: str = ";",
    *,
    raise_at_end: bool = True,
) -> DataFrame:
    """Export each table to ``directory/{name}.csv``; one that fails leaves the rest.

    The report has one row per table. If any failed, it is raised after all were tried.
    """

    def export(name: str, open_table: Callable[[], DataFrame]) -> tuple:
        try:
            df = open_table()
            # Counted while it is written, without a second pass.
            seen = Observation()
            counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
            path = export_csv(counted, f"{directory.rstrip('/')}/{name}.csv", separator)
            return name, seen.get["n_rows"], path, None
        except Exception as error:  # noqa: BLE001 - reported per table, raised below
            return name, None, None, f"{type(error).__name__}: {error}"

    report = run_together([partial(export, name, opened) for name, opened in tables.items()])
    if raise_at_end and any(error for *_, error in report):
        raise ExportFailed(report)
    return spark.createDataFrame(report, REPORT_SCHEMA)
