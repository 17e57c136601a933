from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import Check, GateFailed
from tidemark.operators.summary import hourly
from tidemark.operators.worklist import missing_dates
from tidemark.plans.catalog import EXPORTED_MARTS, KEYED_PARTITIONS, KEYED_TABLES
from tidemark.plans.jobs import (
    CrawlJob,
    IncrementalJob,
    JobConfig,
    MartRefresh,
    RefreshJob,
    batch_load,
    consolidate,
    crawl_job,
    create_keyed,
    parameter_worklist,
    refresh_jobs,
)
from tidemark.sources.crawl import single_request
from tidemark.sources.files import read_latest_partition, read_rejects
from tidemark.streaming.ingest import ingest_files


@pytest.fixture
def config(tmp_path):
    (tmp_path / "people.csv").write_text("id;name\n1;a\n2;b\n")
    return JobConfig(db_table="stg_people", bronze_dir=str(tmp_path), bronze_file="people.csv")


def test_unknown_setting_is_refused():
    with pytest.raises(TypeError, match="db_tabel"):
        JobConfig(db_table="x", db_tabel="y")


def test_refresh_job_defaults(config, warehouse, rows):
    assert RefreshJob(config, "raw.people").run(warehouse) == 2
    assert rows(warehouse.read("raw.people")) == [(1, "a"), (2, "b")]


def test_refresh_job_with_own_steps(config, warehouse, rows, spark):
    loaded = []
    job = RefreshJob(
        config,
        "raw.people",
        extract=lambda spark, cfg: spark.createDataFrame([(3, cfg.db_table)], "id int, name string"),
        transform=lambda df: df.withColumn("id", F.col("id") * 2),
        load=lambda df, wh, target: loaded.append((target, rows(df))) or 1,
    )
    assert job.run(warehouse) == 1
    assert loaded == [("raw.people", [(6, "stg_people")])]
    assert not warehouse.spark.catalog.databaseExists(warehouse.database("raw"))


def test_refresh_job_stops_at_a_failed_check(config, warehouse, rows):
    RefreshJob(config, "raw.people").run(warehouse)
    strict = RefreshJob(config, "raw.people", checks=[Check("regex", "name", "^a")])
    with pytest.raises(GateFailed, match="regex"):
        strict.run(warehouse)
    assert rows(warehouse.read("raw.people")) == [(1, "a"), (2, "b")]


def test_refresh_jobs_of_the_catalog(warehouse, tmp_path, rows):
    folder = tmp_path / "ecidadania" / "status"
    folder.mkdir(parents=True)
    (folder / "senado_status_consolidado.csv").write_text("id;status\n1;open\n")
    jobs = refresh_jobs(str(tmp_path), {"raw.raw_senado_status": [Check("unique", "id")]})
    assert len(jobs) == 10
    assert len(EXPORTED_MARTS) == 8
    assert jobs["raw.raw_senado_status"].run(warehouse) == 1
    assert rows(warehouse.read("raw.raw_senado_status")) == [(1, "open")]


def test_consolidate(spark, tmp_path):
    assert consolidate(spark, str(tmp_path), "csv", str(tmp_path / "out")) is None
    (tmp_path / "1.csv").write_text("a;b\n1;x\n")
    (tmp_path / "2.csv").write_text("b;a\nx;1\n")
    path = consolidate(spark, str(tmp_path), "csv", str(tmp_path / "out"))
    assert spark.read.csv(path, sep=";", header=True).count() == 2


def test_keyed_tables_can_be_created(warehouse):
    for name, (columns, key) in KEYED_TABLES.items():
        create_keyed(warehouse, name)
        assert warehouse.key(name) == key
        assert warehouse.definition(name).partition == KEYED_PARTITIONS[name]
        assert {t for _, t in warehouse.read(name).dtypes} == {"string"}


def test_nothing_missing_runs_no_step(warehouse, spark):
    warehouse.create_table("raw.d", "date string", key=["date"])
    warehouse.upsert(spark.createDataFrame([("2024-01-01",)], "date string"), "raw.d")

    def never(_):
        raise AssertionError("must not run")

    job = IncrementalJob(
        worklist=lambda w: missing_dates(w.read("raw.d"), "date", end="2024-01-01"),
        extract=never,
        derive={"raw.d": never},
    )
    before = warehouse.location("raw.d")
    assert job.run(warehouse) is False
    assert warehouse.location("raw.d") == before


def test_batch_load_without_files_keeps_the_table(warehouse, spark, tmp_path, rows):
    warehouse.load(spark.range(1), "raw.kept")
    (tmp_path / "a.txt").write_text("x")
    assert batch_load(warehouse, str(tmp_path), "csv", "raw.kept") is None
    assert batch_load(warehouse, str(tmp_path), "json", "raw.kept") is None
    assert rows(warehouse.read("raw.kept")) == [(0,)]
    with pytest.raises(ValueError, match="unknown file type"):
        batch_load(warehouse, str(tmp_path), "xml", "raw.kept")


def test_batch_load_json(warehouse, tmp_path, rows):
    (tmp_path / "home.json").write_text(json.dumps([{"title": "A", "price": 1.5}]))
    assert batch_load(warehouse, str(tmp_path), "json", "raw.home") == 1
    assert rows(warehouse.read("raw.home"), "title", "price", "source_filename") == [("A", 1.5, "home.json")]


def test_crawl_of_a_single_document(warehouse, spark, tmp_path, rows):
    def client():
        return lambda url: '{"id": 1, "url": "%s"}' % url

    job = CrawlJob(
        url="{url}",
        file_name="{file_name}",
        target="raw.summary",
        open_client=client,
        load_documents=lambda landed: landed.selectExpr("file_name", "get_json_object(body, '$.id') AS id"),
        how="replace",
    )
    request = single_request(spark, "https://x.invalid/games", "games.json")
    assert job.run(request, warehouse, str(tmp_path / "landing")).isEmpty()
    assert rows(warehouse.read("raw.summary")) == [("games.json", "1")]


def test_crawl_without_any_answer_keeps_the_table(warehouse, spark, tmp_path, rows):
    def client():
        def fetch(url):
            raise OSError("down")

        return fetch

    warehouse.load(spark.createDataFrame([("old",)], "body string"), "raw.summary")
    job = CrawlJob(
        url="{url}", file_name="{file_name}", target="raw.summary", open_client=client,
        load_documents=lambda landed: landed.select("body"), wait=0.0, how="replace",
    )
    failed = job.run(single_request(spark, "u", "f"), warehouse, str(tmp_path / "landing"))
    assert rows(failed, "error") == [("OSError: down",)]
    assert rows(warehouse.read("raw.summary")) == [("old",)]


def test_crawl_lands_by_season(warehouse, spark, tmp_path, rows):
    def client():
        def fetch(url):
            if url.endswith("9"):
                raise OSError("closed")
            return url[-1]

        return fetch

    log = spark.createDataFrame([(1, "20232024"), (2, "20242025"), (9, "20242025")], "player int, season string")
    landing = str(tmp_path / "log")
    job = CrawlJob(
        url="https://x.invalid/{season}/{player}",
        file_name="{player}.json",
        target="raw.log",
        open_client=client,
        load_documents=lambda landed: landed.select("player", "body"),
        wait=0.0,
        partition_by="season",
    )
    failed = job.run(log, warehouse, landing)
    assert rows(failed, "player", "error") == [(9, "OSError: closed")]
    assert rows(warehouse.read("raw.log")) == [(1, "1"), (2, "2")]
    latest = read_latest_partition(spark, landing, "season", "player int, body string, season string")
    assert rows(latest, "player", "season") == [(2, "20242025")]


def test_marts_by_tag(warehouse, spark):
    refresh = MartRefresh(
        marts={"marts.a": lambda w: w.spark.range(1), "marts.b": lambda w: w.spark.range(2)},
        tags={"first": ["marts.a"]},
    )
    assert refresh.run(warehouse, "first") == {"marts.a": 1}
    assert not warehouse.exists("marts.b")
    assert refresh.run(warehouse) == {"marts.a": 1, "marts.b": 2}
    with pytest.raises(ValueError, match="unknown tag"):
        refresh.run(warehouse, "third")


SCHEMA = "ts timestamp_ntz, value double, sent int"
HOURS = "datetime string, energy double"


def drop(directory, name, *readings):
    directory.mkdir(exist_ok=True)
    data = [{"ts": ts, "value": v, "sent": s} for ts, v, s in readings]
    (directory / name).write_text(json.dumps(data))


def by_hour(batch):
    return hourly(batch, "ts", "value")


def test_stream_loads_each_file_once(spark, warehouse, tmp_path, rows):
    landing, archive = tmp_path / "landing", tmp_path / "bronze"
    warehouse.create_table("raw.h", HOURS, key=["datetime"])

    def ingest():
        return ingest_files(
            spark, str(landing), SCHEMA, str(tmp_path / "checkpoint"), warehouse,
            {"raw.h": by_hour}, archive=str(archive),
        )

    drop(landing, "1.json", ("2024-01-01T00:10:00", 1.0, 1), ("2024-01-01T01:10:00", 2.0, 1))
    assert ingest() == 1
    assert ingest() == 0
    drop(landing, "2.json", ("2024-01-01T01:10:00", 5.0, 2), ("2024-01-01T02:00:00", 3.0, 2))
    drop(landing, "note.txt")
    assert ingest() == 1
    assert rows(warehouse.read("raw.h")) == [
        ("2024-01-01 00:00:00", 1.0), ("2024-01-01 01:00:00", 5.0), ("2024-01-01 02:00:00", 3.0),
    ]


def test_stream_orders_two_files_of_one_batch(spark, warehouse, tmp_path, rows):
    landing = tmp_path / "landing"
    warehouse.create_table("raw.h", f"{HOURS}, sent int", key=["datetime"])
    drop(landing, "1.json", ("2024-01-01T01:10:00", 5.0, 2))
    drop(landing, "2.json", ("2024-01-01T01:10:00", 2.0, 1))

    def last_sent(batch):
        return batch.selectExpr("date_format(ts, 'yyyy-MM-dd HH:00:00') AS datetime", "value AS energy", "sent")

    ingest_files(
        spark, str(landing), SCHEMA, str(tmp_path / "c1"), warehouse, {"raw.h": last_sent}, order_by=["sent"]
    )
    assert rows(warehouse.read("raw.h")) == [("2024-01-01 01:00:00", 5.0, 2)]
    drop(landing, "3.json", ("2024-01-01T01:10:00", 1.0, 1), ("2024-01-01T02:10:00", 7.0, 1))
    ingest_files(
        spark, str(landing), SCHEMA, str(tmp_path / "c1"), warehouse, {"raw.h": last_sent}, order_by=["sent"]
    )
    assert rows(warehouse.read("raw.h")) == [("2024-01-01 01:00:00", 5.0, 2), ("2024-01-01 02:00:00", 7.0, 1)]
    warehouse.create_table("raw.h2", HOURS, key=["datetime"])
    with pytest.raises(Exception, match="lacks the order columns"):
        ingest_files(
            spark, str(landing), SCHEMA, str(tmp_path / "c3"), warehouse, {"raw.h2": last_sent}, order_by=["sent"]
        )
    with pytest.raises(Exception, match="more than once"):
        ingest_files(
            spark, str(landing), SCHEMA, str(tmp_path / "c2"), warehouse,
            {"raw.h2": lambda b: last_sent(b).drop("sent")},
        )


def test_stream_into_a_partitioned_table(spark, warehouse, tmp_path, rows):
    landing = tmp_path / "landing"
    by_day = ("day", "substring(datetime, 1, 10)")
    warehouse.create_table("raw.h", HOURS, key=["datetime"], partition=by_day)
    drop(landing, "1.json", ("2024-01-01T00:10:00", 1.0, 1), ("2024-01-02T01:10:00", 2.0, 1))
    drop(landing, "2.json", ("2024-01-02T01:20:00", 7.0, 2))
    os.utime(landing / "1.json", (1, 1))
    batches = ingest_files(
        spark, str(landing), SCHEMA, str(tmp_path / "c"), warehouse, {"raw.h": by_hour}, max_files=1
    )
    assert batches == 2
    first, second = rows(warehouse.read("raw.h"))
    assert first == ("2024-01-01 00:00:00", 1.0, "2024-01-01")
    assert second[0] == "2024-01-02 01:00:00" and second[1] == 7.0


def test_stream_refuses_null_keys(spark, warehouse, tmp_path, rows):
    landing = tmp_path / "landing"
    warehouse.create_table("raw.h", HOURS, key=["datetime"])
    drop(landing, "1.json", (None, 5.0, 2))
    with pytest.raises(Exception, match="NULL key"):
        ingest_files(
            spark, str(landing), SCHEMA, str(tmp_path / "c"), warehouse,
            {"raw.h": lambda b: b.selectExpr("cast(ts AS string) AS datetime", "value AS energy")},
        )
    assert rows(warehouse.read("raw.h")) == []


def test_stream_keeps_bad_records_aside(spark, warehouse, tmp_path, rows):
    landing, rejects = tmp_path / "landing", str(tmp_path / "rejects")
    warehouse.create_table("raw.h", HOURS, key=["datetime"])
    drop(landing, "1.json", ("2024-01-01T01:10:00", 5.0, 2))
    (landing / "bad 1.json").write_text("{bad")

    def ingest(checkpoint, **options):
        ingest_files(
            spark, str(landing), SCHEMA, str(tmp_path / checkpoint), warehouse, {"raw.h": by_hour}, **options
        )

    with pytest.raises(Exception, match="bad record in bad 1.json"):
        ingest("c1")
    assert rows(warehouse.read("raw.h")) == []
    ingest("c2", rejects=rejects)
    assert rows(warehouse.read("raw.h")) == [("2024-01-01 01:00:00", 5.0)]
    assert rows(read_rejects(spark, rejects)) == [("bad 1.json", "{bad")]


def test_a_daily_delivery_rewrites_its_month_only(spark, warehouse):
    name = "raw.solar_daily_energy"
    create_keyed(warehouse, name)
    columns, _ = KEYED_TABLES[name]
    job = IncrementalJob(lambda w: None, lambda missing: None, {name: lambda rows: rows})

    def deliver(*days):
        job.publish(spark.createDataFrame([(d, "1", "2", "3", "4") for d in days], columns), warehouse)
        found = warehouse.read(name).select("month", "_metadata.file_path").distinct().collect()
        return {r["month"]: r["file_path"] for r in found}

    before = deliver("2024-01-30", "2024-01-31", "2024-02-01")
    after = deliver("2024-02-02")
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] != before["2024-02"]


def test_crawl_from_a_configuration(spark, warehouse, tmp_path, rows):
    (tmp_path / "ids.csv").write_text("id;name\n1;a\n2;b\n1;c\n;d\n")
    config = JobConfig(
        db_table="raw.people",
        url_base="https://x.invalid/{id}",
        landing_dir=str(tmp_path / "landing"),
        landing_file="{id}.json",
        parameter_file=str(tmp_path / "ids.csv"),
    )
    job = crawl_job(
        config, lambda: lambda url: url[-1], load_documents=lambda d: d.select("file_name", "body"), wait=0.0
    )
    assert job.run(parameter_worklist(spark, config, "id"), warehouse, config.landing_dir).isEmpty()
    assert rows(warehouse.read("raw.people")) == [("1.json", "1"), ("2.json", "2")]
