"""Which dates, ids or request tuples still have to be loaded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def _calendar(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day; an inverted range gives none, where a bare sequence would count down."""
    days = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    return bounds.select(F.explode(days).alias("day"))


def missing_dates(
    loaded: DataFrame, column: str, *, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Days in a range that have no row in ``loaded``.

    The range defaults to the first and last loaded day; a text that is no date is ignored. The
    table is read once and reduced to distinct days in each task; the days between two neighbours
    are the gaps. The window holds days of the calendar, not rows of the table.
    """
    days = loaded.select(F.col(column).try_cast("date").alias("day")).where("day IS NOT NULL")
    before, after = (F.date_sub(F.lit(start), 1), F.date_add(F.lit(end), 1))
    if start:
        days = days.where(F.col("day") >= before)
    if end:
        days = days.where(F.col("day") <= after)
    if start or end:
        # The days just outside the range stand for its ends.
        fences = [before] if start else []
        fences += [after] if end else []
        fence = loaded.sparkSession.range(1).select(F.explode(F.array(*fences)).alias("day"))
        if start and end:
            fence = fence.where(before < after)
        days = days.unionByName(fence)
    following = F.lead("day").over(Window.orderBy("day"))
    pairs = days.distinct().select(
        F.date_add("day", 1).alias("first"), F.date_sub(following, 1).alias("last")
    )
    return _calendar(pairs, F.col("first"), F.col("last"))


def high_watermark(loaded: DataFrame, column: str) -> DataFrame:
    return loaded.agg(F.max(F.col(column).try_cast("date")).alias("mark"))


def dates_since_watermark(
    tables: Sequence[tuple[DataFrame, str]], today: str, *, start: str | None = None
) -> DataFrame:
    """Days after the oldest of the tables' last days, up to ``today``.

    Taking the least mark re-requests days that one table has and another lacks. An empty table
    has no mark: ``start`` says where its days begin, and without a ``start`` no day is known to
    be missing.
    """
    marks = reduce(DataFrame.unionByName, [high_watermark(df, col) for df, col in tables])
    floor = F.date_sub(F.lit(start).cast("date"), 1) if start else F.lit(None).cast("date")
    lowest = marks.select(F.coalesce("mark", floor).alias("mark")).agg(
        F.when(F.count("mark") == F.count(F.lit(1)), F.min("mark")).alias("mark")
    )
    return _calendar(lowest, F.date_add("mark", 1), F.lit(today).cast("date"))


def loaded_ids(loaded: DataFrame, id_column: str, key: str) -> DataFrame:
    """Distinct, non-NULL ids of a detail table, under the name of the entity key."""
    ids = loaded.select(F.col(id_column).alias(key))
    return ids.where(F.col(key).isNotNull()).distinct()


def request_flags(
    entities: DataFrame, key: str, details: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """``entities`` with one boolean per detail table: is this key loaded there?

    Detail ids are made distinct before they meet the entities, so no join multiplies rows and a
    key with many detail rows costs one.
    """
    flagged = entities
    for flag, (loaded, id_column) in details.items():
        ids = loaded_ids(loaded, id_column, key).withColumn(flag, F.lit(True))
        flagged = flagged.join(ids, key, "left").withColumn(flag, F.col(flag).isNotNull())
    return flagged


def pending_ids(entities: DataFrame, key: str, loaded: DataFrame, id_column: str) -> DataFrame:
    """Distinct keys of ``entities`` without a row in ``loaded``.

    Both sides are distinct before the join; a key with a third of all detail rows could not be
    split on the right side of an anti join.
    """
    keys = entities.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(loaded_ids(loaded, id_column, key), key, "left_anti")


def id_bitmaps(rows: DataFrame, id_column: str) -> DataFrame:
    """The ids of ``rows`` as bitmaps: ``bucket, bits``, one row for each stretch of 32,768 numbers.

    Ids are whole numbers; NULL is no id. What a delivery brings is a small table of bitmaps that
    ``merged_bitmaps`` adds to those kept for the detail table, so that nothing ever scans the details
    again to know which ids they hold.
    """
    number = F.col(id_column).cast("bigint")
    given = rows.where(number.isNotNull())
    return given.groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )


def merged_bitmaps(*parts: DataFrame) -> DataFrame:
    """The ids of all parts."""
    return reduce(DataFrame.unionByName, parts).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def flags_by_bitmap(entities: DataFrame, key: str, details: Mapping[str, DataFrame]) -> DataFrame:
    """``request_flags`` from bitmaps of the loaded ids instead of the detail tables.

    The join is on the bucket, which has one bitmap; entities crowd in a bucket no more than numbers do,
    32,768 at most.
    """
    number = F.col(key).cast("bigint")
    position = F.bitmap_bit_position(number)
    flagged = entities
    for flag, bitmaps in details.items():
        side = bitmaps.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
        byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        there = F.getbit(byte, (position % 8).cast("int")) == 1
        joined = flagged.join(side, F.bitmap_bucket_number(number) == F.col("_bucket"), "left")
        flagged = joined.withColumn(flag, F.coalesce(there, F.lit(False))).drop("_bucket", "_bits")
    return flagged


def pending_by_bitmap(entities: DataFrame, key: str, loaded: DataFrame) -> DataFrame:
    """``pending_ids`` from the bitmaps of the loaded ids."""
    keys = entities.select(key).where(F.col(key).isNotNull()).distinct()
    return flags_by_bitmap(keys, key, {"_loaded": loaded}).where("NOT _loaded").select(key)


def request_tuples(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Distinct request parameters, e.g. (team, season, game type)."""
    exprs = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return df.select(*exprs).distinct()


def flagged(df: DataFrame, flag: str, value: bool, columns: Sequence[str]) -> DataFrame:
    """Projection under a boolean equality; a NULL flag equals neither value."""
    return df.where(F.col(flag) == F.lit(value)).select(*columns)
