"""Aggregates kept as partial states that can be merged, and the values they end in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F

How = Literal["sum", "count", "min", "max", "avg"]
# An aggregate and what it is taken of.
Measures = Mapping[str, tuple[How, Column | str]]

# The partial states of each aggregate: suffix, how it comes from values, how states merge.
_STATES = {
    "sum": [("sum", F.sum, F.sum)],
    "count": [("n", F.count, F.sum)],
    "min": [("min", F.min, F.min)],
    "max": [("max", F.max, F.max)],
    "avg": [("sum", F.sum, F.sum), ("n", F.count, F.sum)],
}


def _columns(measures: Measures) -> list[tuple[str, Column | str, tuple]]:
    return [
        (f"{name}__{state[0]}", value, state)
        for name, (how, value) in measures.items()
        for state in _STATES[how]
    ]


def partial_states(rows: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """One row of partial states per key."""
    return rows.groupBy(*keys).agg(*[make(value).alias(name) for name, value, (_, make, _) in _columns(measures)])


def merged_states(states: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """States of equal keys put together; the order does not matter."""
    return states.groupBy(*keys).agg(*[merge(name).alias(name) for name, _, (_, _, merge) in _columns(measures)])


def finished(states: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """The aggregates that the states stand for; a mean of no value is NULL."""
    values = []
    for name, (how, _) in measures.items():
        if how == "avg":
            value = F.col(f"{name}__sum") / F.nullif(F.col(f"{name}__n"), F.lit(0))
        else:
            value = F.col(f"{name}__{_STATES[how][0][0]}")
        values.append(value.alias(name))
    return states.select(*keys, *values)
