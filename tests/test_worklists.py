from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import worklist
from tidemark.sources import crawl


def days(*names):
    return [(f"2024-01-{n:02d}",) for n in names]


def listed(df):
    return sorted(r["day"].day for r in df.collect())


@pytest.fixture
def loaded(spark):
    return lambda *n: spark.createDataFrame(days(*n), "date string")


def test_gap_and_tail(loaded):
    assert listed(worklist.missing_dates(loaded(1, 2, 5, 5), "date", end="2024-01-07")) == [3, 4, 6, 7]


def test_gap_inside_only(loaded):
    assert listed(worklist.missing_dates(loaded(1, 2, 5), "date")) == [3, 4]


def test_head_before_the_first_day(loaded):
    df = worklist.missing_dates(loaded(3, 4), "date", start="2024-01-01", end="2024-01-05")
    assert listed(df) == [1, 2, 5]


def test_days_outside_the_range_do_not_count(loaded):
    df = worklist.missing_dates(loaded(1, 9), "date", start="2024-01-04", end="2024-01-06")
    assert listed(df) == [4, 5, 6]


def test_full_calendar_is_empty(loaded):
    assert worklist.missing_dates(loaded(1, 2, 3), "date", end="2024-01-03").isEmpty()


def test_nothing_loaded(loaded):
    assert listed(worklist.missing_dates(loaded(), "date", start="2024-01-01", end="2024-01-02")) == [1, 2]
    assert worklist.missing_dates(loaded(), "date").isEmpty()


def test_inverted_range_is_empty(loaded):
    for n in ((), (2,), (9,)):
        df = worklist.missing_dates(loaded(*n), "date", start="2024-01-09", end="2024-01-02")
        assert df.isEmpty()


def test_null_dates_are_ignored(spark):
    data = [("2024-01-01",), (None,), ("none",), ("2024-01-03 10:00:00",)]
    df = spark.createDataFrame(data, "date string")
    assert listed(worklist.missing_dates(df, "date")) == [2]
    assert listed(worklist.dates_since_watermark([(df, "date")], "2024-01-05")) == [4, 5]


def test_watermark_takes_the_lowest_table(loaded):
    df = worklist.dates_since_watermark(
        [(loaded(1, 5), "date"), (loaded(2, 3), "date")], "2024-01-07"
    )
    assert listed(df) == [4, 5, 6, 7]


def test_watermark_after_today_is_empty(loaded):
    assert worklist.dates_since_watermark([(loaded(9), "date")], "2024-01-07").isEmpty()


def test_watermark_of_an_empty_table(loaded):
    tables = [(loaded(5), "date"), (loaded(), "date")]
    assert worklist.dates_since_watermark(tables, "2024-01-07").isEmpty()
    assert listed(worklist.dates_since_watermark(tables, "2024-01-03", start="2024-01-02")) == [2, 3]


def test_flag_filter_drops_null(spark, rows):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, flag boolean")
    assert rows(worklist.flagged(df, "flag", False, ["id"])) == [(2,)]


def test_pending_agrees_with_flags(spark, rows):
    games = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "game_id int")
    details = spark.createDataFrame([(2,), (2,), (9,), (None,)], "id int")
    flags = worklist.request_flags(games, "game_id", {"has_details": (details, "id")})
    pending = worklist.pending_ids(games, "game_id", details, "id")
    assert rows(pending) == [(1,), (3,)]
    unloaded = flags.where(~F.col("has_details") & F.col("game_id").isNotNull())
    assert rows(unloaded.select("game_id").distinct()) == rows(pending)
    assert flags.count() == games.count()


def test_request_urls(spark, rows):
    df = spark.createDataFrame([(7, 20242025, 2)], "team_id int, season_id int, game_type_id int")
    made = crawl.with_requests(df, "https://x.invalid/{team_id}/{season_id}?t={game_type_id}", "c_{team_id}.json")
    assert rows(made, "url", "file_name") == [("https://x.invalid/7/20242025?t=2", "c_7.json")]


def test_day_requests(spark, rows):
    df = spark.createDataFrame([(dt.date(2024, 1, 2),)], "day date")
    made = crawl.days_to_requests(df, "https://x.invalid/?date={date}", "{date}.json")
    assert rows(made) == [("2024-01-02", "https://x.invalid/?date=2024-01-02", "2024-01-02.json")]


def test_failed_request_keeps_its_row(spark, rows):
    def flaky_client():
        """Odd pages work at once, page 2 at the second try, page 4 never."""
        tries: dict[str, int] = {}

        def fetch(url: str) -> str:
            tries[url] = tries.get(url, 0) + 1
            if url.endswith("4") or (url.endswith("2") and tries[url] == 1):
                raise TimeoutError("slow")
            return f"body {url[-1]}"

        return fetch

    requests = spark.range(1, 6).selectExpr("concat('https://x.invalid/', id) AS url")
    df = crawl.fetch_documents(requests, flaky_client, parallelism=2, attempts=2, wait=0.0)
    got = {r["url"][-1]: (r["body"], r["error"]) for r in df.collect()}
    assert got["1"] == ("body 1", None)
    assert got["2"] == ("body 2", None)
    assert got["4"] == (None, "TimeoutError: slow")
    assert len(got) == 5


def test_landing_keeps_every_document(spark, tmp_path, rows):
    path = str(tmp_path / "landing")
    schema = "file_name string, body string, season string"

    def land(*documents):
        done = [(*d, None if d[1] else "OSError: down") for d in documents]
        return crawl.land_documents(spark.createDataFrame(done, f"{schema}, error string"), path, "season")

    def landed():
        return rows(crawl.read_landed(spark, path, schema, "season"))

    assert landed() == []
    land(("a", "1", "s1"), ("b", "1", "s1"), ("a", "1", "s2"))
    failed = land(("z", "2", "s1"), ("a", "2", "s1"), ("b", None, "s1"))
    assert rows(failed.where("error IS NOT NULL"), "file_name") == [("b",)]
    assert landed() == [("a", "1", "s2"), ("a", "2", "s1"), ("b", "1", "s1"), ("z", "2", "s1")]
    land(("a", None, "s1"), ("b", None, "s1"))
    assert len(landed()) == 4


def test_fetch_leaves_ids_alone_and_reports_missing_urls(spark, rows):
    def client():
        return lambda url: f"at {url}"

    big = 9007199254740993
    requests = spark.createDataFrame([(big, f"u/{big}"), (None, None)], "id bigint, url string")
    df = crawl.fetch_documents(requests, client, parallelism=1, wait=0.0)
    assert rows(df) == [(None, None, None, crawl.NO_URL), (big, f"u/{big}", f"at u/{big}", None)]


def test_parameter_ids(spark, rows):
    df = spark.createDataFrame([("1",), ("2",), ("1",), (None,)], "id string")
    assert rows(crawl.parameter_ids(df, "id")) == [("1",), ("2",)]
    assert rows(crawl.single_request(spark, "u", "f")) == [("u", "f")]
