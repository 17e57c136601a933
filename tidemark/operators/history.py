"""Dated snapshots folded into intervals of validity, and facts joined to the interval they fall in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def validity_intervals(snapshots: DataFrame, key: Sequence[str], day: str, state: Sequence[str]) -> DataFrame:
    """One row per key and unbroken run of one state: ``valid_from``, ``valid_to`` and the snapshots seen.

    A snapshot day lists all keys there are. An interval runs from the first day of a state to, and not
    including, the next snapshot day that shows the key in another state or not at all; ``valid_to`` is NULL
    while the last snapshot still shows it. A state that comes back has a new interval. Equal rows count
    once, and two states of a key on one day have an interval each. Rows without a day are left out.

    Days are numbered once, over the distinct days; the run numbers come from windows over one key and state, which
    have a row per day at most.
    """
    dated = snapshots.where(F.col(day).isNotNull()).select(*key, *state, F.col(day).alias("_day")).distinct()
    days = dated.select("_day").distinct().withColumn("_n", F.row_number().over(Window.orderBy("_day")))
    next_days = days.select((F.col("_n") - 1).alias("_last"), F.col("_day").alias("valid_to"))
    own = [*key, *state]
    run = F.col("_n") - F.row_number().over(Window.partitionBy(*own).orderBy("_n"))
    runs = dated.join(days, "_day").withColumn("_run", run).groupBy(*own, "_run").agg(
        F.min("_day").alias("valid_from"), F.max("_n").alias("_last"), F.count(F.lit(1)).alias("snapshots")
    )
    return runs.join(next_days, "_last", "left").select(*own, "valid_from", "valid_to", "snapshots")


def as_of(facts: DataFrame, intervals: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """``facts`` with the columns of the interval of their key that ``at`` falls in, NULL without one.

    An equi-join on the key; a key has few intervals. A fact in two intervals, where a key has two
    states at a time, has a row for each.
    """
    others = [c for c in intervals.columns if c not in key]
    side = intervals.select(*[F.col(k).alias(f"_{k}") for k in key], *others)
    same = F.lit(True)
    for k in key:
        same = same & (F.col(k) == F.col(f"_{k}"))
    within = (F.col(at) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to")))
    return facts.join(side, same & within, "left").drop(*[f"_{k}" for k in key])
