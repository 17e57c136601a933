"""Time expressions that read TIMESTAMP and TIMESTAMP_NTZ alike.

``date_trunc`` moves a zone-less timestamp into the session zone, where an hour can be missing
or doubled; date and hour parts do not.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def hour_label(day: Column, hour: Column) -> Column:
    """``yyyy-MM-dd HH:00:00`` from a date and an hour number."""
    return F.concat(
        day.cast("string"), F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00")
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Whole elapsed seconds."""
    return F.call_function("div", end - start, F.expr("INTERVAL '1' SECOND"))
