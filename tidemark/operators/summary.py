"""Intraday readings to hourly and daily rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import day_of, hour_label, seconds_between


def hourly(
    readings: DataFrame,
    ts: str,
    value: str,
    aggregate: Callable[[Column], Column] = F.sum,
) -> DataFrame:
    """``datetime, energy``: one row per hour that has a reading.

    Hours are grouped as a date and a number; the label is made from the few grouped rows.
    """
    keyed = readings.where(F.col(ts).isNotNull())
    grouped = keyed.groupBy(day_of(F.col(ts)).alias("day"), F.hour(ts).alias("hour"))
    return grouped.agg(aggregate(F.col(value)).alias("energy")).select(
        hour_label(F.col("day"), F.col("hour")).alias("datetime"), "energy"
    )


def daily_summary(
    readings: DataFrame, ts: str, value: str, co2: Column | None = None
) -> DataFrame:
    """``date, duration, total, co2, max``: one row per day that has a reading.

    ``duration`` is the seconds from the first to the last reading. ``co2`` sums a column of the
    source and is NULL where the source has none; no conversion factor is invented.
    """
    keyed = readings.where(F.col(ts).isNotNull())
    carried = F.sum(co2) if co2 is not None else F.lit(None).cast("double")
    return keyed.groupBy(day_of(F.col(ts)).alias("day")).agg(
        seconds_between(F.min(ts), F.max(ts)).alias("duration"),
        F.sum(value).alias("total"),
        carried.alias("co2"),
        F.max(value).alias("max"),
    ).select(F.col("day").cast("string").alias("date"), "duration", "total", "co2", "max")


def hour_profile(readings: DataFrame, ts: str, value: str) -> DataFrame:
    """Total and mean reading per hour of the day, over all days."""
    return readings.where(F.col(ts).isNotNull()).groupBy(F.hour(ts).alias("hour")).agg(
        F.count(value).alias("readings"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
    )
