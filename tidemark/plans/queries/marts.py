"""Derived tables over the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import normalise_text
from tidemark.operators import history, summary
from tidemark.operators.fuzzy import match_names, match_token_sets
from tidemark.plans import marts
from tidemark.plans.queries.registry import register, table, working_area


def energy_days(events: DataFrame) -> DataFrame:
    days = summary.daily_summary(events, "ts", "value")
    return days.select("date", F.round("total", 2).alias("energy"), "max")


def climate_days(orders: DataFrame, shift: int) -> DataFrame:
    """Order days moved by ``shift`` days, as the second daily source."""
    day = F.date_add(F.to_date("o_orderdate"), shift)
    days = orders.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("turnover")
    )
    return days.select(F.col("day").cast("string").alias("date"), "orders", "turnover")


# Days from 1995-01-01, the first order day, to 2024-01-01, the first event day.
SHIFT = 10592


@register(
    f"""
WITH energy AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, round(sum(value), 2) AS energy, max(value) AS max
  FROM events GROUP BY 1
), climate AS (
  SELECT strftime(CAST(o_orderdate AS DATE) + {SHIFT}, '%Y-%m-%d') AS date, count(*) AS orders,
    round(sum(o_totalprice), 2) AS turnover
  FROM orders GROUP BY 1
)
SELECT date, energy, max, orders, turnover FROM energy JOIN climate USING (date)
"""
)
def daily_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    energy = energy_days(table(spark, sf_dir, "events"))
    return marts.daily_join(energy, climate_days(table(spark, sf_dir, "orders"), SHIFT))


@register(
    """
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(value) AS readings, round(sum(value), 2) AS total,
  round(avg(value), 6) AS mean
FROM events GROUP BY 1
"""
)
def hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = summary.hour_profile(table(spark, sf_dir, "events"), "ts", "value")
    return profile.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 6)})


@register(
    """
SELECT o_custkey, count(o_orderstatus) AS votes, count(*) FILTER (WHERE o_orderstatus = 'F') AS aligned,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(o_orderstatus), 6) AS rate
FROM orders GROUP BY 1
"""
)
def alignment_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = F.col("o_orderstatus") == "F"
    rates = marts.alignment_rate(table(spark, sf_dir, "orders"), "o_custkey", aligned)
    return rates.withColumn("rate", F.round("rate", 6))


@register(
    """
SELECT o_custkey, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter,
  count(o_orderstatus) AS votes, count(*) FILTER (WHERE o_orderstatus = 'F') AS aligned,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(o_orderstatus), 6) AS rate
FROM orders GROUP BY 1, 2
"""
)
def quarterly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = marts.alignment_rate_by_quarter(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", F.col("o_orderstatus") == "F"
    )
    return rates.withColumn("rate", F.round("rate", 6))


@register(
    """
WITH monthly AS (
  SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS month,
    round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 6) AS mean_price
  FROM lineitem GROUP BY 1, 2
), changed AS (
  SELECT *, lag(mean_price) OVER (PARTITION BY l_partkey ORDER BY month) AS previous_price
  FROM monthly
)
SELECT l_partkey, month, mean_price, previous_price, round(mean_price / previous_price - 1, 6) AS change
FROM changed
"""
)
def price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    lineitem = table(spark, sf_dir, "lineitem")
    changes = marts.price_change(lineitem, "l_partkey", "l_shipdate", price)
    return changes.withColumn("change", F.round("change", 6))


@register(
    """
SELECT conv_id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1
"""
)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.latest_snapshot(table(spark, sf_dir, "conversations"), "conv_id", ["turn"])


@register(
    """
SELECT role, count(DISTINCT conv_id) AS keys, count(*) AS snapshots,
  CAST(sum(length(text)) AS BIGINT) AS total
FROM conversations GROUP BY 1
"""
)
def snapshot_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return marts.snapshot_totals(turns, "conv_id", "role", F.length("text"))


@register(
    """
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name, o.orders, o.turnover, o.last_order
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (
  SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS turnover,
    strftime(max(o_orderdate), '%Y-%m-%d') AS last_order
  FROM orders GROUP BY 1
) o ON c.c_custkey = o.o_custkey
"""
)
def one_big_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.sum("o_totalprice"), 2).alias("turnover"),
        F.to_date(F.max("o_orderdate")).cast("string").alias("last_order"),
    )
    wide = marts.one_big_table(
        table(spark, sf_dir, "customer"),
        {
            "c_custkey": (per_customer, "o_custkey"),
            "c_nationkey": (table(spark, sf_dir, "nation"), "n_nationkey"),
            "n_regionkey": (table(spark, sf_dir, "region"), "r_regionkey"),
        },
    )
    return wide.select(
        "c_custkey", "c_name", "n_name", "r_name", "orders", "turnover", "last_order"
    )


@register(
    """
WITH top AS (
  SELECT * FROM orders
  WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01'
    AND o_orderdate < TIMESTAMP '1998-01-01'
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 700
)
SELECT CAST(rank() OVER (ORDER BY o_totalprice DESC) AS INTEGER) AS rank, o_orderkey, o_totalprice,
  c_name, n_name, r_name
FROM top
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
"""
)
def topk_with_includes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 700 best of one status and year; the related entities join the 700, not the table."""
    status = F.col("o_orderstatus") == "F"
    year = (F.col("o_orderdate") >= "1997-01-01") & (F.col("o_orderdate") < "1998-01-01")
    orders = table(spark, sf_dir, "orders")
    top = marts.top_ranked(orders, "o_totalprice", "o_orderkey", 700, status & year)
    wide = marts.include_related(
        top,
        {
            "o_custkey": (table(spark, sf_dir, "customer"), "c_custkey"),
            "c_nationkey": (table(spark, sf_dir, "nation"), "n_nationkey"),
            "n_regionkey": (table(spark, sf_dir, "region"), "r_regionkey"),
        },
    )
    return wide.select("rank", "o_orderkey", "o_totalprice", "c_name", "n_name", "r_name")


@register(
    """
WITH c AS (
  SELECT replace(c_name, 'Customer#', '') AS name, count(*) AS n FROM customer GROUP BY 1
), s AS (
  SELECT replace(s_name, 'Supplier#', '') AS name, count(*) AS n FROM supplier GROUP BY 1
)
SELECT c.name AS left_name, s.name AS right_name, c.n AS left_rows, s.n AS right_rows,
  CAST(levenshtein(c.name, s.name) AS INTEGER) AS distance
FROM c, s WHERE levenshtein(c.name, s.name) <= 1
"""
)
def fuzzy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    def bare(name: str):
        return normalise_text(F.regexp_replace(name, "^[A-Za-z]+#", ""))

    return match_names(
        table(spark, sf_dir, "customer"), bare("c_name"),
        table(spark, sf_dir, "supplier"), bare("s_name"),
    )


_TOKENS = "list_distinct(list_filter(string_split({0}, ' '), lambda x: x <> ''))"


@register(
    f"""
WITH p AS (SELECT p_name AS name, {_TOKENS.format("p_name")} AS w, count(*) AS n FROM part GROUP BY 1, 2),
s AS (SELECT text AS name, {_TOKENS.format("text")} AS w, count(*) AS n FROM (
  SELECT 'the ' || p_name || ' ' || p_brand AS text FROM part) GROUP BY 1, 2),
c AS (
  SELECT p.name AS left_name, s.name AS right_name, p.n AS left_rows, s.n AS right_rows,
    CAST(len(list_intersect(p.w, s.w)) AS INTEGER) AS common, CAST(len(p.w) + len(s.w) AS INTEGER) AS n_words
  FROM p, s
)
SELECT left_name, right_name, left_rows, right_rows, common, n_words - common AS total FROM c
WHERE 100 * common >= 50 * (n_words - common)
"""
)
def token_set_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names against longer ones with an article and a brand, by words in common."""
    part = table(spark, sf_dir, "part")
    longer = F.concat(F.lit("the "), "p_name", F.lit(" "), "p_brand")
    return match_token_sets(part, F.col("p_name"), part, longer, percent=50)


# Three deliveries of hours: each starts before the one before ends, with corrected readings.
DELIVERIES = (("2024-01-01", "2024-01-13", 1), ("2024-01-11", "2024-01-22", 2), ("2024-01-20", "2025-01-01", 3))


@register(
    """
WITH hours AS (
  SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS datetime,
    sum(CAST(value AS DECIMAL(18, 4)) * CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 3 WHEN ts >= TIMESTAMP '2024-01-11' THEN 2 ELSE 1 END)
      AS energy
  FROM events GROUP BY 1
)
SELECT CAST(substr(datetime, 12, 2) AS INTEGER) AS hour, count(*) AS readings, CAST(sum(energy) AS DOUBLE) AS total,
  CAST(min(energy) AS DOUBLE) AS least, CAST(max(energy) AS DOUBLE) AS most, round(CAST(sum(energy) AS DOUBLE) / count(*), 6) AS mean
FROM hours GROUP BY 1
"""
)
def marts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile of the day, refreshed after each delivery from the days that it touched."""
    events = table(spark, sf_dir, "events")
    value = F.col("value").cast("decimal(18,4)")
    name = "raw.hours"
    measures = {
        "readings": ("count", "energy"),
        "total": ("sum", "energy"),
        "least": ("min", "energy"),
        "most": ("max", "energy"),
        "mean": ("avg", "energy"),
    }
    with working_area(spark) as warehouse:
        warehouse.create_table(
            name,
            "datetime string, hour int, energy decimal(28,4)",
            key=["datetime"],
            partition=("day", "substr(datetime, 1, 10)"),
        )
        for start, end, factor in DELIVERIES:
            sent = events.where((F.col("ts") >= start) & (F.col("ts") < end))
            hours = sent.groupBy(F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("datetime")).agg(
                F.sum(value * factor).alias("energy")
            )
            warehouse.upsert(hours.withColumn("hour", F.substring("datetime", 12, 2).cast("int")), name)
            marts.refresh_by_delta(warehouse, name, "marts.profile", ["hour"], measures)
        profile = warehouse.read("marts.profile")
    numbers = {c: F.col(c).cast("double") for c in ("total", "least", "most")}
    mean = F.round(F.col("total").cast("double") / F.col("readings"), 6)
    return profile.withColumn("mean", mean).withColumns(numbers)


@register(
    """
WITH dated AS (SELECT DISTINCT conv_id, role, turn FROM conversations WHERE turn IS NOT NULL),
days AS (SELECT turn, row_number() OVER (ORDER BY turn) AS n FROM (SELECT DISTINCT turn FROM dated)),
runs AS (
  SELECT conv_id, role, min(turn) AS valid_from, max(n) AS last, count(*) AS snapshots
  FROM (SELECT *, n - row_number() OVER (PARTITION BY conv_id, role ORDER BY n) AS run FROM dated JOIN days USING (turn))
  GROUP BY conv_id, role, run
), intervals AS (
  SELECT conv_id, role, valid_from, d.turn AS valid_to, snapshots FROM runs LEFT JOIN days d ON d.n = last + 1
)
SELECT i.conv_id, i.role, i.valid_from, i.valid_to, i.snapshots, count(c.conv_id) AS votes,
  CAST(coalesce(sum(length(c.text)), 0) AS BIGINT) AS weight
FROM intervals i LEFT JOIN conversations c
  ON c.conv_id = i.conv_id AND c.turn >= i.valid_from AND (i.valid_to IS NULL OR c.turn < i.valid_to)
GROUP BY ALL
"""
)
def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as days: who speaks in a conversation, from when until when, and what falls in that time."""
    turns = table(spark, sf_dir, "conversations")
    own = ["conv_id", "role", "valid_from", "valid_to", "snapshots"]
    intervals = history.validity_intervals(turns, ["conv_id"], "turn", ["role"])
    votes = turns.select("conv_id", "turn", F.length("text").alias("weight"))
    cast = history.as_of(votes, intervals, ["conv_id"], "turn")
    return cast.where("valid_from IS NOT NULL").groupBy(*own).agg(
        F.count(F.lit(1)).alias("votes"), F.coalesce(F.sum("weight"), F.lit(0)).cast("long").alias("weight")
    )
