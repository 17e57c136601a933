"""Reading and writing files: CSV, JSON, HTML, partitions, exports and streams.

The given tables are first written in the file format under test, then read back by the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import normalise_text
from tidemark.operators.shape import explode_parallel, flatten
from tidemark.operators.summary import hourly
from tidemark.plans.catalog import WEATHER_DOCUMENT
from tidemark.plans.queries.registry import register, table, working_area
from tidemark.plans.queries.tables import HOURLY_UPSERT_SQL, split_events
from tidemark.session import scratch_dir
from tidemark.sinks.archive import archive_documents
from tidemark.sinks.export import export_all, export_csv
from tidemark.sources.crawl import parameter_ids, with_requests
from tidemark.sources.files import (
    LINEAGE,
    read_csv_dir,
    read_documents,
    read_json_dir,
    read_latest_partition,
    read_text_csv,
    read_typed_csv,
)
from tidemark.sources.html import links, page_title
from tidemark.streaming.ingest import ingest_files
from tidemark.streaming.partial import add_up_files


@register(
    """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS c_mktsegment
FROM customer
"""
)
def csv_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells as text; the token NA is read as NULL."""
    customer = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    marked = customer.withColumn(
        "c_mktsegment", F.when(segment == "MACHINERY", "NA").otherwise(segment)
    )
    path = export_csv(marked, scratch_dir(spark, "text-csv"), ",")
    return read_text_csv(spark, path, ",", multi_line=False)


@register("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def typed_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = export_csv(part, scratch_dir(spark, "typed-csv"))
    return read_typed_csv(spark, path, part.schema, multi_line=False)


def landed_people(spark: SparkSession, sf_dir: str) -> str:
    """Customers and suppliers as CSV files in one directory, with different headers."""
    directory = scratch_dir(spark, "people")
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS name", "s_nationkey AS nation", "s_suppkey AS id"
    )
    for rows in (customers, suppliers):
        rows.write.mode("append").option("header", True).option("sep", ";").csv(directory)
    return directory


@register(
    """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::BIGINT AS nation,
  TRUE AS has_lineage
FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey, TRUE FROM supplier
"""
)
def union_by_name_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_csv_dir(spark, landed_people(spark, sf_dir), multi_line=False)
    lineage = F.col(LINEAGE).rlike(r"^part-.*\.csv$").alias("has_lineage")
    return rows.select("id", "name", "balance", "nation", lineage)


@register(
    """
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN value END AS value,
  CASE WHEN event_type NOT IN ('click', 'view') THEN event_type END AS kind
FROM events
"""
)
def json_batch_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of JSON files with different fields, loaded as one table."""
    events = table(spark, sf_dir, "events")
    directory = scratch_dir(spark, "json")
    seen = F.col("event_type").isin("click", "view")
    events.where(seen).select("event_id", "value").write.mode("append").json(directory)
    others = events.where(~seen).select("event_id", F.col("event_type").alias("kind"))
    others.write.mode("append").json(directory)
    return read_json_dir(spark, directory, multi_line=False).select("event_id", "value", "kind")


@register("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def document_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON documents by file pattern; the text files next to them are not taken."""
    events = table(spark, sf_dir, "events")
    directory = scratch_dir(spark, "documents")
    props = F.from_json("props", "k int").alias("props")
    events.select("event_id", props).write.mode("append").json(directory)
    events.select("props").write.mode("append").text(directory)
    raw = read_documents(spark, directory, "part-*.json", whole_file=False)
    return raw.select(
        F.variant_get("payload", "$.event_id", "bigint").alias("event_id"),
        F.variant_get("payload", "$.props.k", "int").alias("k"),
    )


def day_documents(events: DataFrame) -> DataFrame:
    """One nested document per day, shaped like the weather source."""
    hour = F.hour("ts")
    k = F.get_json_object("props", "$.k").cast("double")

    def between(low: int, high: int, value):
        return F.when(hour.between(low, high), value)

    value = F.col("value")
    days = events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(between(12, 17, F.when(F.col("event_type") == "view", 1))).alias("views"),
        F.count(between(12, 17, F.lit(1))).alias("afternoon_rows"),
        F.round(F.sum(value), 2).alias("total"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.max(between(12, 17, value)).alias("afternoon"),
        F.max(between(0, 5, value)).alias("night"),
        F.max(between(18, 23, value)).alias("evening"),
        F.max(between(6, 11, value)).alias("morning"),
        F.min(between(12, 17, value)).alias("afternoon_min"),
        F.max(k).alias("speed"),
        F.min(k).alias("direction"),
    )
    return days.selectExpr(
        "cast(day AS string) AS date",
        "named_struct('afternoon', views) AS cloud_cover",
        "named_struct('afternoon', afternoon_rows) AS humidity",
        "named_struct('total', total) AS precipitation",
        "named_struct('min', min, 'max', max, 'afternoon', afternoon, 'night', night, "
        "'evening', evening, 'morning', morning) AS temperature",
        "named_struct('afternoon', afternoon_min) AS pressure",
        "named_struct('max', named_struct('speed', speed, 'direction', direction)) AS wind",
    )


WEATHER_SQL = """
SELECT strftime(ts, '%Y-%m-%d') AS date,
  count(*) FILTER (WHERE hour(ts) BETWEEN 12 AND 17 AND event_type = 'view')::DOUBLE
    AS cloud_cover_afternoon,
  count(*) FILTER (WHERE hour(ts) BETWEEN 12 AND 17)::DOUBLE AS humidity_afternoon,
  round(sum(value), 2) AS precipitation_total,
  min(value) AS temperature_min,
  max(value) AS temperature_max,
  max(value) FILTER (WHERE hour(ts) BETWEEN 12 AND 17) AS temperature_afternoon,
  max(value) FILTER (WHERE hour(ts) BETWEEN 0 AND 5) AS temperature_night,
  max(value) FILTER (WHERE hour(ts) BETWEEN 18 AND 23) AS temperature_evening,
  max(value) FILTER (WHERE hour(ts) BETWEEN 6 AND 11) AS temperature_morning,
  min(value) FILTER (WHERE hour(ts) BETWEEN 12 AND 17) AS pressure_afternoon,
  max(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS wind_max_speed,
  min(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS wind_max_direction
FROM events GROUP BY 1
"""


@register(WEATHER_SQL)
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = scratch_dir(spark, "weather")
    day_documents(table(spark, sf_dir, "events")).write.json(directory)
    documents = read_json_dir(spark, directory, WEATHER_DOCUMENT, multi_line=False)
    return flatten(documents.drop(LINEAGE))


@register(
    """
SELECT vec_id, 'slot ' || unnest(range(len(embedding))) AS slot,
  CAST(unnest(embedding) AS DOUBLE) AS reading
FROM embeddings
"""
)
def intraday_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel arrays of slots and readings, one row per position."""
    vectors = table(spark, sf_dir, "embeddings")
    slots = F.transform("embedding", lambda _, i: F.concat(F.lit("slot "), i.cast("string")))
    documents = vectors.select("vec_id", slots.alias("slots"), "embedding")
    rows = explode_parallel(documents, slot="slots", reading="embedding")
    return rows.withColumn("reading", F.col("reading").cast("double"))


_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"

def _stripped(sql: str) -> str:
    return rf"regexp_replace({sql}, '^\s+|\s+$', '', 'g')"


def _unescaped(sql: str) -> str:
    for reference, character in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "''"),
        ("&amp;", "&"),
    ):
        sql = f"replace({sql}, '{reference}', '{character}')"
    return sql


@register(
    rf"""
WITH visible AS (
  SELECT page_id, regexp_replace(html, '{_HIDDEN}', '', 'g') AS html FROM pages
), pieces AS (
  SELECT page_id, unnest(string_split(html, '<a ')[2:]) AS piece,
    unnest(range(len(string_split(html, '<a ')) - 1)) AS position
  FROM visible
), found AS (
  SELECT page_id, position, split_part(split_part(piece, 'href="', 2), '"', 1) AS href,
    split_part(substr(piece, position('>' IN piece) + 1), '</a>', 1) AS label
  FROM pieces
)
SELECT page_id, CAST(position AS INTEGER) AS position, {_unescaped("href")} AS href,
  {_unescaped(_stripped("regexp_replace(label, '<[^>]*>', '', 'g')"))} AS label
FROM found
"""
)
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(table(spark, sf_dir, "pages").select("page_id", "html"))


@register(
    rf"""
SELECT page_id, url,
  {_unescaped(_stripped("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))} AS title
FROM pages
"""
)
def html_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", page_title(F.col("html")).alias("title"))


@register(
    r"""
SELECT doc_id,
  trim(regexp_replace(lower(strip_accents(text)), '[ \t\r\n]+', ' ', 'g')) AS text
FROM documents
"""
)
def normalised_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", normalise_text(F.col("text")).alias("text"))


@register(
    """
WITH seasons AS (
  SELECT o_orderkey, o_totalprice,
    CAST(year(o_orderdate) AS VARCHAR) || CAST(year(o_orderdate) + 1 AS VARCHAR) AS season
  FROM orders
)
SELECT * FROM seasons WHERE season = (SELECT max(season) FROM seasons)
"""
)
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    season = F.concat(year.cast("string"), (year + 1).cast("string")).alias("season")
    games = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", season)
    base = scratch_dir(spark, "seasons")
    games.write.partitionBy("season").parquet(base)
    return read_latest_partition(spark, base, "season", games.schema)


@register(
    """
SELECT DISTINCT 'https://people.invalid/' || o_custkey AS url, o_custkey || '.json' AS file_name
FROM orders
"""
)
def parameter_file_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze CSV of one job is the id list of the next."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    path = export_csv(ids, scratch_dir(spark, "ids"))
    listed = parameter_ids(read_text_csv(spark, path, ";", multi_line=False), "id")
    return with_requests(listed, "https://people.invalid/{id}", "{id}.json").select(
        "url", "file_name"
    )


@register("SELECT conv_id, turn, role, text FROM conversations")
def csv_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes and separators come back as they were."""
    turns = table(spark, sf_dir, "conversations")
    path = export_csv(turns, scratch_dir(spark, "export"))
    return read_typed_csv(spark, path, turns.schema)


@register(
    """
SELECT 'customer' AS table_name, count(*) AS n_rows, TRUE AS ok FROM customer
UNION ALL SELECT 'orders', count(*), TRUE FROM orders
UNION ALL SELECT 'conversations', count(*), TRUE FROM conversations
UNION ALL SELECT 'absent', NULL, FALSE
"""
)
def export_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables are exported; the fourth is not there and does not stop them."""
    names = ("customer", "orders", "absent", "conversations")
    tables = {n: (lambda n=n: table(spark, sf_dir, n)) for n in names}
    report = export_all(spark, tables, scratch_dir(spark, "gold"), raise_at_end=False)
    return report.select("table_name", "n_rows", F.col("error").isNull().alias("ok"))


@register(
    """
SELECT 'bronze/' || page_id || '.html' AS key,
  CASE WHEN url LIKE 'https:%' THEN html || '<!-- again -->' ELSE html END AS content,
  CAST(strlen(html) + CASE WHEN url LIKE 'https:%' THEN 14 ELSE 0 END AS BIGINT) AS length
FROM pages WHERE html NOT LIKE '%lang="fr"%'
"""
)
def document_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under a key, some sent a second time; names with another suffix case are left out."""
    pages = table(spark, sf_dir, "pages")
    french = F.col("html").contains('lang="fr"')
    suffix = F.when(french, ".HTML").otherwise(".html")
    name = F.concat(F.col("page_id").cast("string"), suffix).alias("file_name")
    sent = pages.select(name, F.col("html").alias("content"))
    again = pages.where(F.col("url").startswith("https:")).select(
        name, F.concat("html", F.lit("<!-- again -->")).alias("content")
    )
    with working_area(spark) as warehouse:
        archive_documents(sent, warehouse, "raw.archive", suffix=".html", digits=1)
        archive_documents(again, warehouse, "raw.archive", suffix=".html", digits=1)
        stored = warehouse.snapshot("raw.archive")
    return stored.select("key", F.col("content").cast("string").alias("content"), "length")


@register(HOURLY_UPSERT_SQL)
def file_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of files, each ingested by the stream; equals the batch upsert."""
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "stream")
    with working_area(spark) as warehouse:
        name = "raw.hourly_energy"
        warehouse.create_table(name, "datetime string, energy double", key=["datetime"])
        for delivery in split_events(spark, sf_dir):
            delivery.select("ts", "value").write.mode("append").json(landing)
            ingest_files(
                spark,
                landing,
                "ts timestamp_ntz, value double",
                checkpoint,
                warehouse,
                {name: lambda batch: hourly(batch, "ts", "value")},
                multi_line=False,
            )
        stored = warehouse.snapshot(name)
    return stored.withColumn("energy", F.round("energy", 2))


@register(
    """
SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS datetime, count(*) AS readings, round(sum(value), 2) AS energy,
  max(value) AS peak FROM events GROUP BY 1
"""
)
def partial_hours_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that no file holds whole: each is split over two deliveries, and readings of some users come
    late in a third; the stream adds them up."""
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select("ts", "value", "event_type")
    early = F.minute("ts") < 30
    late = F.col("event_type") == "view"
    with working_area(spark) as warehouse:
        name = "raw.hours"
        warehouse.create_table(name, "datetime string, readings bigint, energy double, peak double", key=["datetime"])
        for delivery in (events.where(early & ~late), events.where(~early & ~late), events.where(late)):
            delivery.select("ts", "value").write.mode("append").json(landing)
            add_up_files(
                spark,
                landing,
                "ts timestamp_ntz, value double",
                checkpoint,
                warehouse,
                name,
                time="ts",
                span="1 hour",
                delay="40 days",
                measures={"readings": ("count", "ts"), "energy": ("sum", "value"), "peak": ("max", "value")},
                period=("datetime", F.date_format("start", "yyyy-MM-dd HH:mm:ss")),
                multi_line=False,
            )
        stored = warehouse.snapshot(name)
    return stored.withColumn("energy", F.round("energy", 2))


@register(
    """
SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1
"""
)
def table_query_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table read as a whole and by a query."""
    with working_area(spark) as warehouse:
        warehouse.load(table(spark, sf_dir, "orders"), "raw.orders")
        return spark.sql(
            "SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total "
            f"FROM {warehouse.full_name('raw.orders')} GROUP BY o_orderstatus"
        )
