"""Whole jobs over the given data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import fill_template
from tidemark.operators import summary
from tidemark.operators.quality import Check
from tidemark.operators.shape import explode_parallel, flatten
from tidemark.operators.worklist import missing_dates, pending_ids, request_flags
from tidemark.plans import marts
from tidemark.plans.catalog import MART_TAGS, WEATHER_DOCUMENT
from tidemark.plans.jobs import (
    CrawlJob,
    IncrementalJob,
    JobConfig,
    MartRefresh,
    ModelStage,
    RefreshJob,
    Stage,
    batch_load,
    consolidate,
    create_keyed,
    staged_crawl,
)
from tidemark.plans.queries.marts import SHIFT, climate_days, energy_days
from tidemark.plans.queries.registry import register, table, working_area
from tidemark.plans.queries.sources import WEATHER_SQL, day_documents, landed_people
from tidemark.plans.queries.worklists import offline_client
from tidemark.session import scratch_dir, stored
from tidemark.sinks.export import export_csv
from tidemark.sinks.tables import Warehouse
from tidemark.sources.crawl import (
    days_to_requests,
    fetch_documents,
    land_documents,
    read_landed,
    single_request,
    with_requests,
)
from tidemark.sources.files import (
    CORRUPT,
    LINEAGE,
    lineage_column,
    read_json_dir,
    read_rejects,
    read_typed_csv,
    without_rejects,
)


@register(
    """
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier
"""
)
def refresh_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze CSV, checks, gate, replacement."""
    bronze = scratch_dir(spark, "bronze")
    config = JobConfig(db_table="stg_supplier", bronze_dir=bronze, bronze_file="supplier.csv")
    export_csv(table(spark, sf_dir, "supplier"), config.bronze_path)
    job = RefreshJob(
        config,
        "raw.supplier",
        checks=[
            Check("present", "s_name"),
            Check("not_null", "s_suppkey"),
            Check("unique", "s_suppkey"),
            Check("regex", "s_name", "^Supplier#"),
        ],
    )
    with working_area(spark) as warehouse:
        job.run(warehouse)
        return warehouse.snapshot("raw.supplier")


HOURLY, DAILY = "raw.solar_hourly_energy", "raw.solar_daily_energy"
ARCHIVE = "raw.reading_archive"
READING = "event_id bigint, ts timestamp_ntz, value double, k double"

ENERGY_SQL = """
SELECT 'hourly' AS table_name, strftime(ts, '%Y-%m-%d %H:00:00') AS key,
  round(sum(value), 2) AS energy, NULL::BIGINT AS duration, NULL::DOUBLE AS co2
FROM events GROUP BY 2
UNION ALL
SELECT 'daily', strftime(ts, '%Y-%m-%d'), round(sum(value), 2),
  (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000,
  sum(CAST(json_extract_string(props, '$.k') AS DOUBLE))
FROM events GROUP BY 2
"""


def _energy_job(feed: DataFrame, end: str) -> IncrementalJob:
    """The readings of every day up to ``end`` that the daily table lacks."""

    def extract(days: DataFrame) -> DataFrame:
        day = F.to_date(feed["ts"])
        # The range of the missing days prunes the scan; then the days, never more than its length.
        first, last = days.agg(F.min("day"), F.max("day")).first()
        near = feed.where((feed["ts"] >= F.lit(first)) & (feed["ts"] < F.date_add(F.lit(last), 1)))
        wanted = near.join(F.broadcast(days), day == days["day"], "left_semi")
        return stored(wanted, "readings")

    return IncrementalJob(
        worklist=lambda warehouse: missing_dates(
            warehouse.read(DAILY), "date", start="2024-01-01", end=end
        ),
        extract=extract,
        derive={
            HOURLY: lambda rows: summary.hourly(rows, "ts", "value"),
            DAILY: lambda rows: summary.daily_summary(rows, "ts", "value", F.col("k")),
        },
        archive_table=ARCHIVE,
        to_archive=lambda rows: rows.withColumn("day", F.to_date("ts")).select(
            fill_template("{day}/{event_id}.json").alias("file_name"),
            F.to_json(
                # The default format keeps milliseconds only.
                F.struct("event_id", F.col("ts").cast("string").alias("ts"), "value", "k")
            ).alias("content"),
        ),
    )


def _energy_rows(warehouse: Warehouse) -> DataFrame:
    """Text tables typed on the way out."""
    hours = warehouse.snapshot(HOURLY).select(
        F.lit("hourly").alias("table_name"), F.col("datetime").alias("key"), "energy"
    )
    days = warehouse.snapshot(DAILY).select(
        F.lit("daily").alias("table_name"),
        F.col("date").alias("key"),
        F.col("total").alias("energy"),
        "duration",
        "co2",
    )
    rows = hours.unionByName(days, allowMissingColumns=True)
    return rows.withColumns(
        {
            "energy": F.round(F.col("energy").try_cast("double"), 2),
            "duration": F.col("duration").try_cast("bigint"),
            "co2": F.col("co2").try_cast("double"),
        }
    )


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k")
    )


def _run_drops(spark: SparkSession, sf_dir: str, warehouse: Warehouse) -> None:
    for name in (HOURLY, DAILY):
        create_keyed(warehouse, name)
    feed = _feed(spark, sf_dir)
    for end in ("2024-01-10", "2024-01-20", "2024-01-30"):
        _energy_job(feed, end).run(warehouse)


@register(ENERGY_SQL)
def incremental_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, each loading the days still missing; equals one pass over all events."""
    with working_area(spark) as warehouse:
        _run_drops(spark, sf_dir, warehouse)
        return _energy_rows(warehouse)


@register(ENERGY_SQL)
def rebuild_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed tables emptied and built again from the archived documents."""
    with working_area(spark) as warehouse:
        _run_drops(spark, sf_dir, warehouse)
        for name in (HOURLY, DAILY):
            warehouse.truncate(name)
        archived = warehouse.read(ARCHIVE).select(F.col("content").cast("string").alias("text"))
        readings = archived.select(F.from_json("text", READING).alias("doc")).select("doc.*")
        _energy_job(_feed(spark, sf_dir), "2024-01-30").publish(readings, warehouse)
        return _energy_rows(warehouse)


def _detail_client(run: int, failing: str | None):
    """An offline endpoint; with ``failing`` the ids ending in that digit give an error."""

    def open_client():
        def fetch(url: str) -> str:
            game = url.rsplit("/", 1)[1]
            if failing is not None and game.endswith(failing):
                raise ConnectionError("try again")
            return f'{{"game_id": {game}, "run": {run}}}'

        return fetch

    return open_client


@register(
    """
SELECT o_orderkey AS game_id, CAST(CASE WHEN o_orderkey % 10 = 3 THEN 2 ELSE 1 END AS INTEGER) AS run,
  0::BIGINT AS still_pending
FROM orders
"""
)
def staged_crawl_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games are loaded, then the details of the pending ones; what failed once is asked again."""
    landing = scratch_dir(spark, "crawl")

    def pending(warehouse: Warehouse) -> DataFrame:
        return warehouse.read("marts.pending_games")

    def pending_now(warehouse: Warehouse) -> DataFrame:
        games, details = warehouse.read("raw.games"), warehouse.read("raw.game_details")
        return pending_ids(games, "game_id", details, "game_id")

    # The work-list is a model; each crawl reads it as refreshed after the one before.
    models = ModelStage(MartRefresh({"marts.pending_games": pending_now}, {"nhl": ["marts.pending_games"]}), "nhl")

    def stage(run: int, failing: str | None) -> Stage:
        job = CrawlJob(
            url="https://games.invalid/{game_id}",
            file_name="game_{game_id}.json",
            target="raw.game_details",
            open_client=_detail_client(run, failing),
            wait=0.0,
            load_documents=lambda landed: landed.select(
                F.from_json("body", "game_id bigint, run int").alias("doc")
            ).select("doc.*"),
        )
        return Stage(job, pending, f"{landing}/{run}")

    with working_area(spark) as warehouse:
        games = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("game_id"))
        warehouse.load(games, "raw.games")
        warehouse.create_table("raw.game_details", "game_id bigint, run int")
        staged_crawl(warehouse, [models, stage(1, "3"), models, stage(2, None)])
        left = pending_now(warehouse).count()
        return warehouse.snapshot("raw.game_details").withColumn(
            "still_pending", F.lit(left).cast("long")
        )


@register(
    """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::BIGINT AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier
"""
)
def batch_load_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of CSV files into one raw table; a second load replaces the first."""
    directory = landed_people(spark, sf_dir)
    with working_area(spark) as warehouse:
        for _ in range(2):
            batch_load(warehouse, directory, "csv", "raw.people", multi_line=False)
        return warehouse.snapshot("raw.people").select("id", "name", "balance", "nation")


@register("SELECT p_partkey, p_type, p_retailprice FROM part")
def batch_load_json_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of JSON files with a declared schema into one raw table, twice."""
    directory = scratch_dir(spark, "shop")
    table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice").write.json(directory)
    schema = "p_partkey bigint, p_type string, p_retailprice double"
    with working_area(spark) as warehouse:
        for _ in range(2):
            batch_load(
                warehouse, directory, "json", "raw.vide_raw_home_featured", schema=schema, multi_line=False
            )
        return warehouse.snapshot("raw.vide_raw_home_featured").drop(LINEAGE)


@register(
    """
SELECT CAST(json_extract(body, '$.n') AS BIGINT) AS n_orders,
  CAST(json_extract(body, '$.last') AS BIGINT) AS last_order
FROM (SELECT '{"n":' || count(*) || ',"last":' || max(o_orderkey) || '}' AS body FROM orders)
"""
)
def single_document_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document that sums up a source, fetched by a one-row work-list and replaced as a whole."""
    told = table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last")
    )
    body = told.select(F.to_json(F.struct("n", "last")).alias("body")).first()["body"]
    job = CrawlJob(
        url="{url}",
        file_name="{file_name}",
        target="raw.summary",
        open_client=lambda: lambda url: body,
        load_documents=lambda landed: landed.select(
            F.from_json("body", "n bigint, last bigint").alias("doc")
        ).selectExpr("doc.n AS n_orders", "doc.last AS last_order"),
        wait=0.0,
        how="replace",
    )
    request = single_request(spark, "https://games.invalid/summary", "summary.json")
    with working_area(spark) as warehouse:
        for _ in range(2):
            job.run(request, warehouse, scratch_dir(spark, "summary"))
        return warehouse.snapshot("raw.summary")


DAY_DOCUMENT = "date string, time array<string>, energy array<double>"


@register(
    """
SELECT 'hourly' AS table_name, strftime(ts, '%Y-%m-%d %H:00:00') AS key, round(sum(value), 2) AS energy
FROM events GROUP BY 2
UNION ALL SELECT 'daily', strftime(ts, '%Y-%m-%d'), round(sum(value), 2) FROM events GROUP BY 2
"""
)
def intraday_documents_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day documents with parallel arrays, one row per slot, into the hourly and the daily table."""
    landing = scratch_dir(spark, "intraday")
    events = table(spark, sf_dir, "events")
    # Documents of a part of a day each, as a source sends them.
    slots = F.sort_array(F.collect_list(F.struct(F.date_format("ts", "HH:mm:ss").alias("t"), "value")))
    events.groupBy(F.to_date("ts").cast("string").alias("date"), F.hour("ts").alias("h")).agg(
        slots.alias("s")
    ).select("date", F.col("s.t").alias("time"), F.col("s.value").alias("energy")).write.json(landing)
    documents = read_json_dir(spark, landing, DAY_DOCUMENT, multi_line=False)
    readings = stored(
        explode_parallel(documents, time="time", energy="energy").select(
            F.to_timestamp_ntz(F.concat_ws(" ", "date", "time")).alias("ts"), F.col("energy").alias("value")
        ),
        "intraday",
    )
    derive = {
        HOURLY: lambda rows: summary.hourly(rows, "ts", "value"),
        DAILY: lambda rows: summary.daily_summary(rows, "ts", "value"),
    }
    with working_area(spark) as warehouse:
        for name in derive:
            create_keyed(warehouse, name)
        job = IncrementalJob(lambda w: readings, lambda missing: readings, derive)
        job.run(warehouse)
        return _energy_rows(warehouse).select("table_name", "key", "energy")


@register(
    """
SELECT DISTINCT conv_id, role, CASE WHEN role = 'user' THEN turn END AS turn FROM conversations
"""
)
def consolidated_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files with different fields, one of them sent twice, as one CSV without repeats."""
    turns = table(spark, sf_dir, "conversations")
    landing = scratch_dir(spark, "snapshots")
    asked = turns.where(F.col("role") == "user").select("conv_id", "role", "turn")
    answered = turns.where(F.col("role") != "user").select("conv_id", "role")
    for rows in (asked, answered, answered):
        rows.write.mode("append").json(landing)
    path = consolidate(
        spark, landing, "json", scratch_dir(spark, "bronze"), unique=True, multi_line=False
    )
    schema = "conv_id bigint, role string, turn bigint"
    return read_typed_csv(spark, path, schema, multi_line=False)


WEATHER = "raw.openweather_daily"


@register(WEATHER_SQL)
def weather_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested day documents of the missing dates, flattened and upserted, in two runs."""
    landing = scratch_dir(spark, "weather")
    day_documents(table(spark, sf_dir, "events")).write.json(landing)
    documents = read_json_dir(spark, landing, WEATHER_DOCUMENT, multi_line=False).drop(LINEAGE)

    def job(end: str) -> IncrementalJob:
        return IncrementalJob(
            worklist=lambda warehouse: missing_dates(
                warehouse.read(WEATHER), "date", start="2024-01-01", end=end
            ),
            extract=lambda days: documents.join(
                F.broadcast(days.select(F.col("day").cast("string").alias("date"))),
                "date",
                "left_semi",
            ),
            derive={WEATHER: flatten},
        )

    with working_area(spark) as warehouse:
        create_keyed(warehouse, WEATHER)
        for end in ("2024-01-12", "2024-01-30"):
            job(end).run(warehouse)
        days = warehouse.snapshot(WEATHER).drop("month")
    return days.select(
        "date", *[F.col(c).try_cast("double").alias(c) for c in days.columns if c != "date"]
    )


@register(
    """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
missing AS (
  SELECT CAST(day AS VARCHAR) AS date FROM (
    SELECT CAST(unnest(generate_series(
      DATE '1994-12-25', DATE '2001-08-10', INTERVAL 1 DAY)) AS DATE) AS day
  ) WHERE day NOT IN (SELECT day FROM days)
)
SELECT date, 'https://weather.invalid/day?date=' || date AS url, date || '.json' AS file_name,
  '{"url": "https://weather.invalid/day?date=' || date || '", "status": 200}' AS body
FROM missing
"""
)
def missing_day_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per day without an order, fetched and landed."""
    orders = table(spark, sf_dir, "orders")
    days = missing_dates(orders, "o_orderdate", start="1994-12-25", end="2001-08-10")
    requests = days_to_requests(days, "https://weather.invalid/day?date={date}", "{date}.json")
    fetched = fetch_documents(requests, offline_client, parallelism=4, wait=0.0)
    return land_documents(fetched, scratch_dir(spark, "days")).drop("error")


@register(
    """
SELECT o_orderkey AS player, CAST(year(o_orderdate) AS VARCHAR) AS season,
  CASE WHEN o_orderkey % 3 = 0 THEN 'first' ELSE 'second' END AS body
FROM orders
"""
)
def season_crawl_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two crawls into the same seasons: the union of their files, the later one of each name."""
    orders = table(spark, sf_dir, "orders")
    worklist = orders.select(
        F.col("o_orderkey").alias("player"), F.year("o_orderdate").cast("string").alias("season")
    )
    landing = scratch_dir(spark, "seasons")

    def client(answer: str):
        return lambda: lambda url: answer

    for left_out, answer in ((2, "first"), (0, "second")):
        requests = with_requests(
            worklist.where(F.col("player") % 3 != left_out), "https://x.invalid/{player}", "{player}.json"
        )
        fetched = fetch_documents(requests, client(answer), parallelism=4, wait=0.0)
        land_documents(fetched, landing, "season")
    schema = "player bigint, file_name string, body string, season string"
    return read_landed(spark, landing, schema, "season").select("player", "season", "body")


def _listed_price():
    return F.col("l_extendedprice").cast("decimal(18,2)")


def _aligned():
    return F.col("o_orderstatus") == "F"


def _per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("turnover")
    )


# Mart, its plan, and the measure that is summed to compare it.
MARTS = {
    "marts.mrt_energia_clima": (
        lambda w: marts.daily_join(
            energy_days(w.read("raw.events")), climate_days(w.read("raw.orders"), SHIFT)
        ),
        "energy",
    ),
    "marts.mrt_energia_hora": (
        lambda w: summary.hour_profile(w.read("raw.events"), "ts", "value"),
        "total",
    ),
    "marts.mrt_inflation": (
        lambda w: marts.price_change(
            w.read("raw.lineitem"), "l_partkey", "l_shipdate", _listed_price()
        ),
        "mean_price",
    ),
    "marts.mrt_governismo_parlamentares": (
        lambda w: marts.alignment_rate(w.read("raw.orders"), "o_custkey", _aligned()),
        "votes",
    ),
    "marts.mrt_governismo_parlamentares_trimestral": (
        lambda w: marts.alignment_rate_by_quarter(
            w.read("raw.orders"), "o_custkey", "o_orderdate", _aligned()
        ),
        "votes",
    ),
    "marts.mrt_obt_parlamentares": (
        lambda w: marts.one_big_table(
            w.read("raw.customer"), {"c_custkey": (_per_customer(w.read("raw.orders")), "o_custkey")}
        ),
        "turnover",
    ),
    "marts.mrt_ecidadania_bignumbers": (
        lambda w: marts.snapshot_totals(
            w.read("raw.conversations"), "conv_id", "role", F.length("text")
        ),
        "total",
    ),
    "marts.mrt_ecidadania_proposicoes": (
        lambda w: marts.latest_snapshot(w.read("raw.conversations"), "conv_id", ["turn"]),
        "turn",
    ),
    "marts.vw_stg_request_games_id": (
        lambda w: request_flags(
            w.read("raw.orders").select("o_orderkey"),
            "o_orderkey",
            {"has_games_details": (w.read("raw.lineitem"), "l_orderkey")},
        ),
        "has_games_details",
    ),
    "marts.mrt_vide_precos": (
        lambda w: marts.price_range(w.read("raw.part"), "p_type", "p_retailprice"),
        "offers",
    ),
}

TAGGED = dict(
    zip(
        MART_TAGS,
        (
            ["marts.mrt_energia_clima", "marts.mrt_energia_hora"],
            ["marts.mrt_inflation"],
            ["marts.vw_stg_request_games_id"],
            ["marts.mrt_vide_precos"],
        ),
    )
)


@register(
    f"""
SELECT 'mrt_energia_clima' AS mart, count(*) AS n_rows, round(sum(energy), 2) AS total FROM (
  SELECT CAST(ts AS DATE) AS day, sum(value) AS energy FROM events GROUP BY 1
) WHERE day IN (SELECT CAST(o_orderdate AS DATE) + {SHIFT} FROM orders)
UNION ALL
SELECT 'mrt_energia_hora', count(DISTINCT hour(ts)), round(sum(value), 2) FROM events
UNION ALL
SELECT 'mrt_inflation', count(*), round(sum(mean_price), 2) FROM (
  SELECT avg(l_extendedprice) AS mean_price FROM lineitem
  GROUP BY l_partkey, strftime(l_shipdate, '%Y-%m')
)
UNION ALL
SELECT 'mrt_governismo_parlamentares', count(DISTINCT o_custkey), count(*)::DOUBLE FROM orders
UNION ALL
SELECT 'mrt_governismo_parlamentares_trimestral',
  count(DISTINCT (o_custkey, year(o_orderdate), quarter(o_orderdate))), count(*)::DOUBLE FROM orders
UNION ALL
SELECT 'mrt_obt_parlamentares', (SELECT count(*) FROM customer), round(sum(o_totalprice), 2)
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT 'mrt_ecidadania_bignumbers', count(DISTINCT role), sum(length(text))::DOUBLE
FROM conversations
UNION ALL
SELECT 'mrt_ecidadania_proposicoes', count(*), sum(turn)::DOUBLE FROM (
  SELECT conv_id, max(turn) AS turn FROM conversations GROUP BY 1
)
UNION ALL
SELECT 'vw_stg_request_games_id', count(*),
  (count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)))::DOUBLE FROM orders
UNION ALL
SELECT 'mrt_vide_precos', count(DISTINCT p_type), count(*)::DOUBLE FROM part
"""
)
def marts_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources published, marts refreshed by tag and as a whole, all exported, then counted."""
    refresh = MartRefresh({name: plan for name, (plan, _) in MARTS.items()}, TAGGED)
    with working_area(spark) as warehouse:
        for name in ("events", "orders", "lineitem", "customer", "conversations", "part"):
            warehouse.load(table(spark, sf_dir, name), f"raw.{name}")
        refresh.run(warehouse, "energia")
        refresh.run(warehouse)
        refresh.export(warehouse, scratch_dir(spark, "gold"))
        totals = [
            warehouse.snapshot(name).agg(
                F.lit(name.split(".")[1]).alias("mart"),
                F.count(F.lit(1)).alias("n_rows"),
                F.round(F.sum(F.col(measure).cast("double")), 2).alias("total"),
            )
            for name, (_, measure) in MARTS.items()
        ]
        return reduce(DataFrame.unionByName, totals)


@register(
    """
SELECT 'loaded' AS kind, count(*) AS n FROM customer
UNION ALL SELECT 'rejected', count(*) FROM supplier
"""
)
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON lines with a broken line for each supplier between them."""
    landing, rejects = scratch_dir(spark, "mixed"), scratch_dir(spark, "rejects")
    good = table(spark, sf_dir, "customer").select(F.to_json(F.struct("c_custkey", "c_name")).alias("value"))
    bad = table(spark, sf_dir, "supplier").select(F.concat(F.lit("{bad "), "s_name").alias("value"))
    good.unionByName(bad).write.option("compression", "none").text(f"{landing}/lines")
    # The text writer's suffix is another one; the loader takes every file it is given.
    rows = spark.read.schema(f"c_custkey bigint, c_name string, {CORRUPT} string").option(
        "columnNameOfCorruptRecord", CORRUPT
    ).json(f"{landing}/lines")
    loaded = without_rejects(rows.select("*", lineage_column()), F.col(CORRUPT).isNotNull(), rejects)
    counts = [("loaded", loaded), ("rejected", read_rejects(spark, rejects))]
    return reduce(
        DataFrame.unionByName,
        [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, rows in counts],
    )
