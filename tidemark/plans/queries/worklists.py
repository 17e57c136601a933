"""What is missing, pending or to be requested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.worklist import dates_since_watermark as since_watermark
from tidemark.operators.worklist import flagged, id_bitmaps, merged_bitmaps, pending_by_bitmap
from tidemark.operators.worklist import missing_dates as find_missing
from tidemark.operators.worklist import pending_ids as find_pending
from tidemark.operators.worklist import request_flags as flag_requests
from tidemark.operators.worklist import request_tuples
from tidemark.plans.queries.registry import register, table, working_area
from tidemark.session import scratch_dir
from tidemark.sources.crawl import fetch_documents, read_landed, with_requests
from tidemark.streaming.crawl import crawl_queue, queue_requests


@register(
    """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
calendar AS (
  SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM days
)
SELECT CAST(day AS VARCHAR) AS day FROM calendar WHERE day NOT IN (SELECT day FROM days)
"""
)
def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = find_missing(table(spark, sf_dir, "orders"), "o_orderdate")
    return days.select(F.col("day").cast("string").alias("day"))


@register(
    """
WITH marks AS (
  SELECT max(ts)::DATE AS mark FROM events WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-21'
  UNION ALL
  SELECT max(ts)::DATE FROM events WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-17'
)
SELECT CAST(CAST(unnest(generate_series(
  min(mark) + 1, DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS day
FROM marks
"""
)
def dates_since_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    views = events.where((F.col("event_type") == "view") & (F.col("ts") < "2024-01-21"))
    clicks = events.where((F.col("event_type") == "click") & (F.col("ts") < "2024-01-17"))
    days = since_watermark([(views, "ts"), (clicks, "ts")], today="2024-02-05")
    return days.select(F.col("day").cast("string").alias("day"))


@register(
    """
SELECT o_orderkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""
)
def pending_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return find_pending(orders, "o_orderkey", lineitem, "l_orderkey")


@register(
    """
SELECT o_orderkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""
)
def pending_ids_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from bitmaps of loaded ids, which each of two deliveries adds to."""
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    returned = F.col("l_returnflag") == "R"
    schema = "bucket bigint, bits binary"
    with working_area(spark) as warehouse:
        name = "raw.loaded_orders"
        warehouse.create_table(name, schema, key=["bucket"])
        for delivery in (lineitem.where(returned), lineitem.where(~returned)):
            bitmaps = id_bitmaps(delivery, "l_orderkey")
            touched = warehouse.read(name).join(bitmaps.select("bucket"), "bucket", "left_semi")
            warehouse.upsert(merged_bitmaps(touched, bitmaps), name)
        return pending_by_bitmap(orders, "o_orderkey", warehouse.read(name))


@register(
    """
SELECT o_orderkey,
  o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has_details,
  o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS has_return,
  o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O') AS has_open
FROM orders
"""
)
def request_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    details = {
        "has_details": (lineitem, "l_orderkey"),
        "has_return": (lineitem.where(F.col("l_returnflag") == "R"), "l_orderkey"),
        "has_open": (lineitem.where(F.col("l_linestatus") == "O"), "l_orderkey"),
    }
    return flag_requests(orders.select("o_orderkey"), "o_orderkey", details)


@register(
    """
SELECT DISTINCT
  'https://stats.invalid/' || l_suppkey || '/' || year(l_shipdate) || '/' || l_linenumber AS url,
  'stats_' || l_suppkey || '_' || year(l_shipdate) || '_' || l_linenumber || '.json' AS file_name
FROM lineitem
"""
)
def request_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    tuples = request_tuples(
        table(spark, sf_dir, "lineitem"),
        team_id="l_suppkey",
        season_id=F.year("l_shipdate"),
        game_type_id="l_linenumber",
    )
    return with_requests(
        tuples,
        "https://stats.invalid/{team_id}/{season_id}/{game_type_id}",
        "stats_{team_id}_{season_id}_{game_type_id}.json",
    ).select("url", "file_name")


@register(
    """
SELECT DISTINCT
  'https://shop.invalid/' || s.s_suppkey || '/search?q=' || p.p_partkey AS url,
  s.s_name || '_' || p.p_partkey || '.csv' AS file_name
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
"""
)
def store_product_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores joined with the products each of them lists, not with every product there is."""
    listed = request_tuples(table(spark, sf_dir, "lineitem"), store="l_suppkey", product="l_partkey")
    stores = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("store"), "s_name")
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product"))
    pairs = listed.join(stores, "store").join(products, "product")
    return with_requests(
        pairs, "https://shop.invalid/{store}/search?q={product}", "{s_name}_{product}.csv"
    ).select("url", "file_name")


@register(
    """
SELECT d.doc_id, d.lang, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE (l.toxic = 1) = FALSE
"""
)
def filtered_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label have a NULL flag and are not returned."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("toxic"))
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    joined = documents.join(labels, "doc_id", "left")
    return flagged(joined, "toxic", False, ["doc_id", "lang", "n_chars"])


@register(
    """
SELECT 'camara' AS house, c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT 'senado', c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'
"""
)
def house_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing, two targets, each by equality on the house."""
    customer = table(spark, sf_dir, "customer")
    houses = {"camara": "BUILDING", "senado": "MACHINERY"}
    lower, upper = (
        customer.where(F.col("c_mktsegment") == segment).select(
            F.lit(house).alias("house"), "c_custkey", "c_name"
        )
        for house, segment in houses.items()
    )
    return lower.unionByName(upper)


def offline_client():
    """A stand-in for an HTTP client: the answer follows from the URL, nation 7 is not found."""

    def fetch(url: str) -> str:
        if "/7/" in url:
            raise LookupError("not found")
        return f'{{"url": "{url}", "status": 200}}'

    return fetch


@register(
    """
WITH requests AS (
  SELECT c_nationkey, 'https://people.invalid/' || c_nationkey || '/' || c_custkey AS url,
         'person_' || c_custkey || '.json' AS file_name
  FROM customer
)
SELECT url, file_name,
  CASE WHEN c_nationkey <> 7 THEN '{"url": "' || url || '", "status": 200}' END AS body,
  CASE WHEN c_nationkey = 7 THEN 'LookupError: not found' END AS error
FROM requests
"""
)
def crawl_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer; a request that fails keeps its row."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    requests = with_requests(
        people, "https://people.invalid/{c_nationkey}/{c_custkey}", "person_{c_custkey}.json"
    ).select("url", "file_name")
    return fetch_documents(requests, offline_client, parallelism=8, attempts=2, wait=0.0)


@register(
    """
SELECT c_custkey AS id, 'customer_' || c_custkey || '.txt' AS file_name,
  'answer to https://host' || (c_nationkey % 3) || '.example/customers/' || c_custkey AS body
FROM customer
"""
)
def queued_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A work-list in two deliveries, crawled batch by batch with a checkpoint."""
    host = (F.col("c_nationkey") % 3).cast("string").alias("host")
    work = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), host)
    requests = with_requests(work, "https://host{host}.example/customers/{id}", "customer_{id}.txt")
    queue, landing = scratch_dir(spark, "queue"), scratch_dir(spark, "landing")
    checkpoint = scratch_dir(spark, "crawl")
    for delivery in (requests.where("host = '0'"), requests.where("host <> '0'")):
        queue_requests(delivery, queue)
        crawl_queue(
            spark, queue, requests.schema, checkpoint, landing, lambda: "answer to {}".format, parallelism=8
        )
    landed = read_landed(spark, landing, "id string, file_name string, body string")
    return landed.withColumn("id", F.col("id").cast("long"))
