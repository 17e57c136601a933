"""Keyed merge and by-name alignment as DataFrame plans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


class ColumnMismatch(ValueError):
    """Staging and target do not have the same column names."""


def align_by_name(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Reorder ``df`` to ``columns``; a missing or an extra column is an error."""
    missing = [c for c in columns if c not in df.columns]
    extra = [c for c in df.columns if c not in columns]
    if missing or extra:
        raise ColumnMismatch(f"missing columns {missing}, unexpected columns {extra}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])


def upsert_frame(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a stored ``target`` replaced by, and extended with, rows of ``staging``.

    A row whose key holds a NULL never conflicts, so it is kept on the target side and added from
    the staging side. Those rows skip the join: they would all hash to one partition and match
    nothing.

    No broadcast is forced. Staging keys go through Spark's own size check; past it the join is a
    shuffle on the key, which is unique on the target side and so cannot be skewed.
    """
    staging = align_by_name(staging, target.columns)
    null_key = _any_null(keys)
    staged = staging.where(~null_key).select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"_key_{i}") for i, k in enumerate(keys)])
    kept = target.where(~null_key).join(staged, same, "left_anti")
    return kept.unionByName(target.where(null_key)).unionByName(staging)


def overlay(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same upsert for two frames that are computed, with unique keys that are never NULL.

    Each side's plan runs once. An anti join would run the staging plan a second time for its keys,
    and Spark would move that join below the target's aggregation, onto every source row.
    """
    staging = align_by_name(staging, target.columns)
    old = target.select(*keys, F.struct(*target.columns).alias("_old"))
    new = staging.select(*keys, F.struct(*target.columns).alias("_new"))
    merged = old.join(new, list(keys), "full_outer")
    # The staged row as a whole, so that a staged NULL replaces a value.
    return merged.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column absent from a frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values of each key; further ties go by the other columns.

    An aggregate, not a window: each task reduces a hot key to one row before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = F.max(F.struct(*order, *rest)).alias("_last")
    return df.groupBy(*keys).agg(picked).select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns]
    )
