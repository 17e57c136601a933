"""Data checks. A report is a DataFrame; a gate raises."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, MapType, StructType, TimestampType


class GateFailed(ValueError):
    """Data did not pass a check, so nothing was published."""


@dataclass(frozen=True)
class Check:
    """One rule on one column. ``arg`` depends on the kind:

    present, not_null, unique: none; type: a Spark type name the text must cast to;
    in_set: the allowed values; range: (low, high), either may be None; regex: a pattern.
    A NULL passes every rule but ``not_null``.
    """

    kind: str
    column: str
    arg: Any = None


KINDS = ("present", "not_null", "unique", "type", "in_set", "range", "regex")


def _broken(check: Check) -> Column:
    """True where a row breaks the rule."""
    value = F.col(f"`{check.column}`")
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "type":
        return value.isNotNull() & value.cast("string").try_cast(check.arg).isNull()
    if check.kind == "in_set":
        return value.isNotNull() & ~value.isin(*check.arg)
    if check.kind == "range":
        low, high = check.arg
        below = value < F.lit(low) if low is not None else F.lit(False)
        above = value > F.lit(high) if high is not None else F.lit(False)
        return value.isNotNull() & (below | above)
    if check.kind == "regex":
        return value.isNotNull() & ~value.rlike(check.arg)
    raise ValueError(f"unknown check {check.kind!r}")


def check_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(check, column, n_bad)`` for every check.

    All row rules share one aggregation, so the data is read once for them, and so do all
    uniqueness rules: each value is a row of its rule and text, values are reduced per task, and one
    shuffle counts those of all columns.
    """
    for check in checks:
        if check.kind not in KINDS:
            raise ValueError(f"unknown check {check.kind!r}")
    absent = {c.column for c in checks if c.column not in df.columns}
    row_rules = [
        c for c in checks if c.column not in absent and c.kind not in ("present", "unique")
    ]
    totals = [
        F.count(F.when(_broken(c), F.lit(1))).alias(f"bad_{i}") for i, c in enumerate(row_rules)
    ]
    entries = [_entry(c, F.col(f"bad_{i}")) for i, c in enumerate(row_rules)]
    for check in checks:
        if check.kind == "present":
            entries.append(_entry(check, F.lit(int(check.column in absent)).cast("long")))
        elif check.column in absent:
            # A rule on a column that is not there breaks for every row.
            entries.append(_entry(check, F.col("n_rows")))
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *totals)
    reports = []
    if entries:
        reports.append(counted.select(F.inline(F.array(*entries))))
    unique = [c for c in checks if c.kind == "unique" and c.column not in absent]
    if unique:
        reports.append(_surplus(df, unique))
    return reduce(DataFrame.unionByName, reports)


def _surplus(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(check, column, n_bad)`` of uniqueness rules: values beyond the first of each kind."""
    values = [F.struct(F.lit(i).alias("rule"), _as_text(df, c.column).alias("value")) for i, c in enumerate(checks)]
    each = df.select(F.inline(F.array(*values))).where("value IS NOT NULL")
    counted = each.groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = counted.groupBy("rule").agg(F.sum(F.col("n") - 1).alias("n_bad"))
    names = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(c.kind).alias("check"), F.lit(c.column).alias("column")) for i, c in enumerate(checks)])
    # One row for each rule.
    rules = df.sparkSession.range(1).select(F.inline(names))
    return rules.join(found, "rule", "left").select("check", "column", F.coalesce("n_bad", F.lit(0)).cast("long").alias("n_bad"))


def _as_text(df: DataFrame, column: str) -> Column:
    """The value as text that is equal where the values are, and differs where they do."""
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, (FloatType, DoubleType)):
        # Both zeros are one value.
        value = value + F.lit(0.0)
    elif isinstance(kind, TimestampType):
        # Local time may come twice.
        value = F.unix_micros(value)
    elif isinstance(kind, BinaryType):
        value = F.hex(value)
    elif isinstance(kind, (ArrayType, MapType, StructType)):
        value = F.to_json(value, {"ignoreNullFields": "false"})
    return value.cast("string")


def _entry(check: Check, n_bad: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check"), F.lit(check.column).alias("column"), n_bad.alias("n_bad")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; keys holding a NULL never collide."""
    complete = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    grouped = df.where(complete).groupBy(*[F.col(f"`{k}`") for k in keys])
    return grouped.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_valid(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``df`` itself if every check passes."""
    if checks:
        # One report row per check, whatever the size of the data.
        broken = check_report(df, checks).where(F.col("n_bad") > 0).collect()
        if broken:
            found = ", ".join(f"{r['check']}({r['column']}): {r['n_bad']}" for r in broken)
            raise GateFailed(f"checks failed: {found}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise GateFailed(f"{what} is empty")
    return df


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    example = duplicate_keys(df, keys).first()
    if example is not None:
        raise GateFailed(f"{what} holds a key more than once, e.g. {example.asDict()}")
    return df


def require_keys(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """No key column may be NULL; needed where a batch can be replayed."""
    null_key = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    if not df.where(null_key).isEmpty():
        raise GateFailed(f"{what} holds a NULL key")
    return df


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``COUNT(*)`` of each table, one row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
