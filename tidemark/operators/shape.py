"""Turning nested documents into flat rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


def _leaves(schema: StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Every struct leaf as a top-level column named by its path: ``wind.max.speed`` gives
    ``wind_max_speed``. Arrays and maps stay as they are. Two paths with one name are an error."""
    paths = list(_leaves(df.schema))
    names = [separator.join(p) for p in paths]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"flattening gives the same column twice: {clashes}")
    quoted = [".".join(f"`{part}`" for part in p) for p in paths]
    return df.select(*[F.col(q).alias(n) for q, n in zip(quoted, names)])


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to string; typing happens later, with ``try_cast``."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def explode_parallel(df: DataFrame, **arrays: str | Column) -> DataFrame:
    """One row per position of parallel arrays; the other columns repeat.

    Arrays of different length are padded with NULL, so no reading is dropped.
    """
    named = {n: F.col(c) if isinstance(c, str) else c for n, c in arrays.items()}
    used = {c for c in arrays.values() if isinstance(c, str)}
    rest = [c for c in df.columns if c not in used]
    zipped = F.arrays_zip(*[c.alias(n) for n, c in named.items()])
    rows = df.select(*rest, zipped.alias("_rows"))
    names = list(named)
    return rows.select(*rest, F.inline("_rows").alias(*names))
