"""Derived tables. Each is one plan from loaded tables to a mart.

Only the names of these marts are given by the source project's exports, so the definitions are
this library's own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import day_of
from tidemark.operators.merge import latest_per_key
from tidemark.operators.states import Measures, finished, merged_states, partial_states
from tidemark.session import stored
from tidemark.sinks.tables import Warehouse


def daily_join(
    energy: DataFrame, climate: DataFrame, date: str = "date", how: str = "inner"
) -> DataFrame:
    """Energy and climate of the same day; both sides hold one row per day."""
    return energy.join(climate, date, how)


def alignment_rate(votes: DataFrame, entity: str, aligned: Column) -> DataFrame:
    """Share of aligned votes per entity over all time. A NULL vote is not counted."""
    return votes.groupBy(entity).agg(*_rate(aligned))


def alignment_rate_by_quarter(
    votes: DataFrame, entity: str, voted_at: str, aligned: Column
) -> DataFrame:
    """The same share per entity and quarter, the quarter as ``2024-Q1``."""
    year, quarter = F.year(voted_at).alias("year"), F.quarter(voted_at).alias("quarter")
    grouped = votes.groupBy(entity, year, quarter).agg(*_rate(aligned))
    label = F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string"))
    return grouped.select(entity, label.alias("quarter"), "votes", "aligned", "rate")


def _rate(aligned: Column) -> list[Column]:
    cast = F.count(aligned)
    hits = F.count(F.when(aligned, 1))
    return [cast.alias("votes"), hits.alias("aligned"), (hits / F.nullif(cast, F.lit(0))).alias("rate")]


def price_change(prices: DataFrame, product: str, day: str, price: Column) -> DataFrame:
    """Mean monthly price per product and its change against the product's previous listed month.

    Give the price as a decimal where the mean must not depend on the order of summation. The
    window runs over months, after the aggregation, so even a product with a third of all price
    rows has one row per month in it.
    """
    first_day = F.trunc(day_of(F.col(day)), "month").alias("first_day")
    monthly = prices.where(F.col(day).isNotNull()).groupBy(product, first_day).agg(
        F.avg(price).cast("double").alias("mean_price")
    )
    before = F.lag("mean_price").over(Window.partitionBy(product).orderBy("first_day"))
    change = F.col("mean_price") / F.nullif(F.col("previous_price"), F.lit(0.0)) - 1
    return monthly.withColumn("previous_price", before).select(
        product,
        F.substring(F.col("first_day").cast("string"), 1, 7).alias("month"),
        "mean_price",
        "previous_price",
        change.alias("change"),
    )


def latest_snapshot(snapshots: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest snapshot of every key."""
    return latest_per_key(snapshots, [key], order)


def snapshot_totals(snapshots: DataFrame, key: str, group: str, measure: Column) -> DataFrame:
    """Keys, snapshots and a summed measure per group."""
    return snapshots.groupBy(group).agg(
        F.countDistinct(key).alias("keys"),
        F.count(F.lit(1)).alias("snapshots"),
        F.sum(measure).alias("total"),
    )


def price_range(listing: DataFrame, category: str, price: str) -> DataFrame:
    """Offers, least, mean and greatest price of each category of a shop's pages."""
    return listing.groupBy(category).agg(
        F.count(price).alias("offers"),
        F.min(price).alias("least"),
        F.avg(price).alias("mean"),
        F.max(price).alias("greatest"),
    )


def one_big_table(
    entities: DataFrame, attributes: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """One row per entity with every attribute table attached by left join.

    ``attributes`` maps the entity's column to an attribute table and that table's unique column.
    A table that is not unique there must be aggregated first, else entities would multiply. Small
    tables are broadcast by Spark's own size check.
    """
    wide = entities
    for column, (table, unique) in attributes.items():
        side = table.withColumnRenamed(unique, "_key")
        wide = wide.join(side, wide[column] == side["_key"], "left").drop("_key")
    return wide


def include_related(
    bounded: DataFrame, attributes: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """``one_big_table`` for a frame of a few rows, such as a top-k.

    The frame is computed once and stored, so Spark knows its size. An attribute table is first cut
    down to the keys the frame holds; while these pass Spark's own size check they are broadcast and
    the table is filtered where it is scanned. A table reached through another
    attribute is joined as it is.
    """
    bounded = stored(bounded, "bounded")
    reduced = {}
    for column, (table, unique) in attributes.items():
        if column in bounded.columns:
            keys = bounded.select(F.col(column).alias("_wanted")).distinct()
            table = table.join(keys, table[unique] == keys["_wanted"], "left_semi")
        reduced[column] = (table, unique)
    return one_big_table(bounded, reduced)


def top_ranked(
    listing: DataFrame, score: str, tie_break: str, take: int, where: Column | None = None
) -> DataFrame:
    """The ``take`` best rows with their rank; equal scores share a rank and are cut by
    ``tie_break``. The rank window sees the taken rows only."""
    chosen = listing if where is None else listing.where(where)
    top = chosen.orderBy(F.desc(score), F.asc(tie_break)).limit(take)
    return top.withColumn("rank", F.rank().over(Window.orderBy(F.desc(score))))


def refresh_by_delta(
    warehouse: Warehouse, source: str, mart: str, keys: Sequence[str], measures: Measures
) -> list[str | None] | None:
    """Bring ``mart``, aggregates of ``source`` per key, up to date; returns the partitions of the source
    that were read, None for all.

    Partial states are kept in ``<mart>__states``, per key and partition of the source. Only partitions that
    changed since the version the states were made of are read; the mart is put together from states,
    which are fewer than rows. The states and the version they stand for are published in one step, so
    a run that fails is made good by the next one.
    """
    partition = warehouse.definition(source).partition
    if partition is None:
        raise ValueError(f"{source} has no partitions to refresh by")
    column, states = partition[0], f"{mart}__states"
    own = [*keys, column]
    version, rows = warehouse.version(source), warehouse.read(source)
    if not warehouse.exists(states):
        empty = partial_states(rows.limit(0), own, measures)
        warehouse.create_table(states, empty.schema, key=own, partition=("_part", f"`{column}`"))
    changed = warehouse.changed_partitions(source, warehouse.source_version(states))
    if changed is None or changed:
        touched = rows
        if changed is not None:
            hit = F.col(f"`{column}`").isin([v for v in changed if v is not None])
            touched = rows.where(hit | F.col(f"`{column}`").isNull() if None in changed else hit)
        warehouse.replace_partitions(partial_states(touched, own, measures), states, changed, source=version)
    merged = merged_states(warehouse.read(states), keys, measures)
    warehouse.load(finished(merged, keys, measures), mart)
    return changed
