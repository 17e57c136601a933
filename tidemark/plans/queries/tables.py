"""Upserts, refreshes, loads and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.merge import overlay
from tidemark.operators.quality import Check, check_report as report_checks
from tidemark.operators.quality import duplicate_keys as find_duplicates
from tidemark.operators.quality import row_counts
from tidemark.operators.summary import daily_summary as summarise_days
from tidemark.operators.summary import hourly
from tidemark.operators.quality import GateFailed
from tidemark.plans.queries.registry import register, table, working_area
from tidemark.sinks.tables import BUCKET

# The target holds the days before the first date, staging the days from the second on; in the
# overlap staging carries corrected readings, twice the old ones.
TARGET_END = "2024-01-21"
STAGING_START = "2024-01-15"

_HOUR = "strftime(ts, '%Y-%m-%d %H:00:00')"

HOURLY_UPSERT_SQL = f"""
WITH target AS (
  SELECT {_HOUR} AS datetime, sum(value) AS energy FROM events
  WHERE ts < TIMESTAMP '{TARGET_END}' GROUP BY 1
), staging AS (
  SELECT {_HOUR} AS datetime, sum(value * 2) AS energy FROM events
  WHERE ts >= TIMESTAMP '{STAGING_START}' GROUP BY 1
)
SELECT datetime, round(energy, 2) AS energy FROM target
WHERE datetime NOT IN (SELECT datetime FROM staging)
UNION ALL SELECT datetime, round(energy, 2) AS energy FROM staging
"""


def split_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    target = events.where(F.col("ts") < TARGET_END)
    staging = events.where(F.col("ts") >= STAGING_START).withColumn("value", F.col("value") * 2)
    return target, staging


@register(HOURLY_UPSERT_SQL)
def hourly_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staging = (hourly(df, "ts", "value") for df in split_events(spark, sf_dir))
    merged = overlay(target, staging, ["datetime"])
    return merged.select("datetime", F.round("energy", 2).alias("energy"))


_DAILY_COLUMNS = """
  strftime(ts, '%Y-%m-%d') AS date,
  (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS duration,
  round(sum({value}), 2) AS total,
  sum(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS co2,
  round(max({value}), 2) AS max
"""


def _daily(readings: DataFrame) -> DataFrame:
    return summarise_days(
        readings, "ts", "value", F.get_json_object("props", "$.k").cast("double")
    ).withColumns({"total": F.round("total", 2), "max": F.round("max", 2)})


@register(f"SELECT {_DAILY_COLUMNS.format(value='value')} FROM events GROUP BY 1")
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(table(spark, sf_dir, "events"))


@register(
    f"""
WITH target AS (
  SELECT {_DAILY_COLUMNS.format(value="value")} FROM events
  WHERE ts < TIMESTAMP '{TARGET_END}' GROUP BY 1
), staging AS (
  SELECT {_DAILY_COLUMNS.format(value="value * 2")} FROM events
  WHERE ts >= TIMESTAMP '{STAGING_START}' GROUP BY 1
)
SELECT * FROM target WHERE date NOT IN (SELECT date FROM staging)
UNION ALL SELECT * FROM staging
"""
)
def daily_upsert_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staging = (_daily(df) for df in split_events(spark, sf_dir))
    with working_area(spark) as warehouse:
        name = "raw.daily_energy"
        warehouse.create_table(name, target.schema, key=["date"])
        warehouse.upsert(target, name)
        warehouse.upsert(staging, name)
        return warehouse.snapshot(name)


@register(
    f"""
WITH keyed AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS key, ts, event_type, value
  FROM events
), target AS (
  SELECT key, event_type, value FROM keyed WHERE ts < TIMESTAMP '{TARGET_END}'
), staging AS (
  SELECT key, event_type, round(value * 2, 2) AS value FROM keyed
  WHERE ts >= TIMESTAMP '{STAGING_START}'
)
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM staging s WHERE s.key = t.key)
UNION ALL SELECT * FROM staging
"""
)
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows has no key; they never conflict and all stay."""
    key = F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("key")
    target, staging = (
        df.select(key, "event_type", F.round("value", 2).alias("value"))
        for df in split_events(spark, sf_dir)
    )
    with working_area(spark) as warehouse:
        name = "raw.readings"
        warehouse.create_table(name, target.schema, key=["key"])
        warehouse.load(target, name, "append")
        warehouse.upsert(staging, name)
        return warehouse.snapshot(name)


@register(
    """
WITH target AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, sum(o_totalprice) AS total, count(*) AS orders
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01' GROUP BY 1
), staging AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, sum(o_totalprice) * 2 AS total,
         count(*) AS orders
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1
), merged AS (
  SELECT * FROM target WHERE date NOT IN (SELECT date FROM staging)
  UNION ALL SELECT * FROM staging
)
SELECT date, round(total, 2) AS total, orders, date[1:4] AS year FROM merged
"""
)
def partitioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the years that staging falls into are read and rewritten."""
    orders = table(spark, sf_dir, "orders")

    def per_day(rows: DataFrame) -> DataFrame:
        totals = rows.groupBy(F.to_date("o_orderdate").alias("day")).agg(
            F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("orders")
        )
        return totals.select(F.col("day").cast("string").alias("date"), "total", "orders")

    old = per_day(orders.where(F.col("o_orderdate") < "1998-07-01"))
    new = per_day(orders.where(F.col("o_orderdate") >= "1998-01-01"))
    new = new.withColumn("total", F.col("total") * 2)

    with working_area(spark) as warehouse:
        name = "raw.order_days"
        by_year = ("year", "substring(date, 1, 4)")
        warehouse.create_table(name, old.schema, key=["date"], partition=by_year)
        warehouse.upsert(old, name)
        warehouse.upsert(new, name)
        return warehouse.snapshot(name).withColumn("total", F.round("total", 2))


@register(
    """
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal + 100, 2) AS c_acctbal, c_mktsegment
FROM customer
"""
)
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load, then a replacement whose columns come in another order."""
    customer = table(spark, sf_dir, "customer")
    corrected = customer.withColumn("c_acctbal", F.round(F.col("c_acctbal") + 100, 2))
    with working_area(spark) as warehouse:
        warehouse.refresh(customer, "raw.customer")
        warehouse.refresh(corrected.select(*reversed(customer.columns)), "raw.customer")
        return warehouse.snapshot("raw.customer")


@register("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    finished = F.col("o_orderstatus") == "F"
    with working_area(spark) as warehouse:
        warehouse.load(orders.where(finished), "raw.orders", "replace")
        warehouse.load(orders.where(~finished).select(*reversed(columns)), "raw.orders", "append")
        return warehouse.snapshot("raw.orders")


@register(
    """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1
"""
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


CHECKS = {
    "customer": [
        Check("present", "c_name"),
        Check("present", "c_phone"),
        Check("not_null", "c_name"),
        Check("unique", "c_custkey"),
        Check("unique", "c_nationkey"),
        Check("in_set", "c_mktsegment", ["BUILDING", "AUTOMOBILE", "MACHINERY"]),
        Check("range", "c_acctbal", (0, 5000)),
        Check("regex", "c_name", "^Customer#[0-9]{9}$"),
        Check("type", "c_mktsegment", "int"),
    ],
    "labels": [Check("in_set", "quality", [1]), Check("unique", "doc_id")],
    "documents": [
        Check("not_null", "text"),
        Check("range", "n_chars", (200, None)),
        Check("regex", "lang", "^(en|fr)$"),
    ],
}


@register(
    r"""
SELECT 'customer' AS table_name, 'present' AS "check", 'c_name' AS "column", 0::BIGINT AS n_bad
UNION ALL SELECT 'customer', 'present', 'c_phone', 1
UNION ALL SELECT 'customer', 'not_null', 'c_name', count(*) FROM customer WHERE c_name IS NULL
UNION ALL SELECT 'customer', 'unique', 'c_custkey', count(c_custkey) - count(DISTINCT c_custkey)
  FROM customer
UNION ALL SELECT 'customer', 'unique', 'c_nationkey',
  count(c_nationkey) - count(DISTINCT c_nationkey) FROM customer
UNION ALL SELECT 'customer', 'in_set', 'c_mktsegment', count(*) FROM customer
  WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')
UNION ALL SELECT 'customer', 'range', 'c_acctbal', count(*) FROM customer
  WHERE c_acctbal < 0 OR c_acctbal > 5000
UNION ALL SELECT 'customer', 'regex', 'c_name', count(*) FROM customer
  WHERE NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')
UNION ALL SELECT 'customer', 'type', 'c_mktsegment', count(*) FROM customer
  WHERE c_mktsegment IS NOT NULL AND TRY_CAST(c_mktsegment AS INTEGER) IS NULL
UNION ALL SELECT 'labels', 'in_set', 'quality', count(*) FROM labels WHERE quality NOT IN (1)
UNION ALL SELECT 'labels', 'unique', 'doc_id', count(doc_id) - count(DISTINCT doc_id) FROM labels
UNION ALL SELECT 'documents', 'not_null', 'text', count(*) FROM documents WHERE text IS NULL
UNION ALL SELECT 'documents', 'range', 'n_chars', count(*) FROM documents WHERE n_chars < 200
UNION ALL SELECT 'documents', 'regex', 'lang', count(*) FROM documents
  WHERE NOT regexp_matches(lang, '^(en|fr)$')
"""
)
def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = [
        report_checks(table(spark, sf_dir, name), checks).withColumn("table_name", F.lit(name))
        for name, checks in CHECKS.items()
    ]
    return reduce(DataFrame.unionByName, reports).select("table_name", "check", "column", "n_bad")


@register(
    """
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events
"""
)
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "lineitem", "events")
    return row_counts({n: table(spark, sf_dir, n) for n in names})


@register("SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def partitioned_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table cut by month, filled, then replaced as a whole; the view moves in one step."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_totalprice"
    )
    with working_area(spark) as warehouse:
        name = "raw.orders_by_month"
        schema = "o_orderkey bigint, day string, o_totalprice double"
        warehouse.create_table(name, schema, key=["o_orderkey", "day"], partition=("month", "substring(day, 1, 7)"))
        warehouse.upsert(orders.withColumn("o_totalprice", F.lit(0.0)), name)
        warehouse.refresh(orders, name)
        return warehouse.snapshot(name).select("o_orderkey", "o_totalprice", "month")


@register("SELECT o_orderkey, o_totalprice FROM orders")
def keyed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends to a keyed table; one that repeats keys is refused and changes nothing."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    with working_area(spark) as warehouse:
        name = "raw.keyed_orders"
        warehouse.create_table(name, orders.schema, key=["o_orderkey"])
        for part in (0, 1):
            warehouse.load(orders.where(F.pmod("o_orderkey", F.lit(2)) == part), name, "append")
        try:
            warehouse.load(orders, name, "append")
        except GateFailed:
            return warehouse.snapshot(name)
        raise AssertionError("a repeated key was appended")


# Orders are keyed by a number that says nothing about their date. The first delivery ends in the second one's
# span; in the overlap the second corrects the price.
ORDERS_END, ORDERS_START = "2001-07-15", "2001-07-01"


@register(
    f"""
SELECT o_orderkey, o_custkey, round(o_totalprice * 2, 2) AS price FROM orders
WHERE o_orderdate >= TIMESTAMP '{ORDERS_START}'
UNION ALL
SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS price FROM orders
WHERE o_orderdate < TIMESTAMP '{ORDERS_START}'
"""
)
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders cut by a hash of their number; an upsert writes only the parts its keys fall into."""
    orders = table(spark, sf_dir, "orders")
    price = F.round("o_totalprice", 2)
    first = orders.where(F.col("o_orderdate") < ORDERS_END).select("o_orderkey", "o_custkey", price.alias("price"))
    price = F.round(F.col("o_totalprice") * 2, 2)
    second = orders.where(F.col("o_orderdate") >= ORDERS_START).select("o_orderkey", "o_custkey", price.alias("price"))
    with working_area(spark) as warehouse:
        name = "raw.orders"
        warehouse.create_table(name, first.schema, key=["o_orderkey"], buckets=32)
        warehouse.upsert(first, name, copy=False)
        warehouse.upsert(second, name)
        return warehouse.read(name).drop(BUCKET)
