"""Database and catalog tables as DataFrames."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    *,
    split_by: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A whole table, or a query, of a database.

    One connection reads everything unless ``split_by`` and ``bounds`` say how to cut the table
    into ranges; use them for any table that does not fit one task. Filters and columns are pushed
    to the database.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split_by:
        if bounds is None:
            raise ValueError("split_by needs bounds")
        if partitions < 2:
            raise ValueError("split_by needs at least two partitions")
        # Spark does not split the query option; a parenthesised query works as a table.
        source = table or f"({query}) q"
        reader = (
            reader.option("dbtable", source)
            .option("partitionColumn", split_by)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", partitions)
        )
    elif table:
        reader = reader.option("dbtable", table)
    else:
        reader = reader.option("query", query)
    return reader.load()


def scalar_row(spark: SparkSession, query: str) -> Row | None:
    """First row of a query, None when it has no rows."""
    return spark.sql(query).first()
