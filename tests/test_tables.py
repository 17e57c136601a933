from __future__ import annotations

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators.merge import ColumnMismatch, latest_per_key, overlay
from tidemark.operators.quality import GateFailed

DAYS = "date string, total bigint"


@pytest.fixture
def days(spark, warehouse):
    warehouse.create_table("raw.days", DAYS, key=["date"])
    warehouse.load(spark.createDataFrame([("d1", 1), ("d2", 2)], DAYS), "raw.days", "append")
    return warehouse


def test_upsert_updates_inserts_and_keeps(spark, days, rows):
    days.upsert(spark.createDataFrame([("d2", 20), ("d3", 30)], DAYS), "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 20), ("d3", 30)]


def test_upsert_goes_by_column_name(spark, days, rows):
    staging = spark.createDataFrame([(20, "d2")], "total bigint, date string")
    days.upsert(staging, "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 20)]


def test_upsert_takes_the_types_of_the_table(spark, days, warehouse, rows):
    days.upsert(spark.createDataFrame([("d2", "20")], "date string, total string"), "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 20)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        days.upsert(spark.createDataFrame([("d2", "many")], "date string, total string"), "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 20)]


def test_upsert_null_keys_never_conflict(spark, days, rows):
    staging = spark.createDataFrame([(None, 7)], DAYS)
    days.upsert(staging, "raw.days")
    days.upsert(staging, "raw.days")
    assert rows(days.read("raw.days")) == [(None, 7), (None, 7), ("d1", 1), ("d2", 2)]


def test_upsert_can_reject_null_keys(spark, days, rows):
    with pytest.raises(GateFailed, match="NULL key"):
        days.upsert(spark.createDataFrame([(None, 7)], DAYS), "raw.days", reject_null_keys=True)
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 2)]


def test_upsert_rejects_a_key_staged_twice(spark, days, rows):
    with pytest.raises(GateFailed, match="more than once"):
        days.upsert(spark.createDataFrame([("d2", 3), ("d2", 4)], DAYS), "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 2)]


def test_upsert_writes_a_staged_null_value(spark, days, rows):
    days.upsert(spark.createDataFrame([("d2", None)], DAYS), "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", None)]


def test_upsert_twice_is_the_same(spark, days, rows):
    staging = spark.createDataFrame([("d2", 20), ("d3", 30)], DAYS)
    for _ in range(2):
        days.upsert(staging, "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 20), ("d3", 30)]


def test_upsert_with_two_keys(spark, warehouse, rows):
    schema = "a string, b int, v int"
    warehouse.create_table("raw.pairs", schema, key=["a", "b"])
    warehouse.upsert(spark.createDataFrame([("x", 1, 1), ("x", 2, 1), ("x", None, 1)], schema), "raw.pairs")
    warehouse.upsert(spark.createDataFrame([("x", 2, 9), ("x", None, 9)], schema), "raw.pairs")
    assert rows(warehouse.read("raw.pairs")) == [
        ("x", None, 1), ("x", None, 9), ("x", 1, 1), ("x", 2, 9),
    ]


def test_upsert_needs_a_key(spark, warehouse):
    warehouse.create_table("raw.free", DAYS)
    with pytest.raises(ValueError, match="no declared key"):
        warehouse.upsert(spark.createDataFrame([], DAYS), "raw.free")


@pytest.mark.parametrize("seed", range(4))
def test_upserts_equal_a_dictionary(spark, warehouse, rows, seed):
    """Random deliveries, with NULL keys, against a plain dictionary and a list."""
    rng = random.Random(seed)
    warehouse.create_table("raw.flat", DAYS, key=["date"])
    warehouse.create_table("raw.cut", DAYS, key=["date"], partition=("m", "substr(date, 1, 1)"))
    keyed, unkeyed = {}, []
    for _ in range(3):
        names = rng.sample([f"{m}-{d}" for m in "abc" for d in range(4)], rng.randint(0, 8))
        delivery = [(n, rng.choice([None, rng.randint(0, 99)])) for n in names]
        nulls = [(None, rng.randint(0, 99)) for _ in range(rng.randint(0, 2))]
        keyed.update(delivery)
        unkeyed += nulls
        staging = spark.createDataFrame(delivery + nulls, DAYS)
        warehouse.upsert(staging, "raw.flat")
        warehouse.upsert(staging, "raw.cut", copy=rng.random() < 0.5)
    expected = sorted(
        [*keyed.items(), *unkeyed], key=lambda r: [(v is not None, str(v)) for v in r]
    )
    assert rows(warehouse.read("raw.flat")) == expected
    assert rows(warehouse.read("raw.cut"), "date", "total") == expected


def test_partitioned_upsert_rewrites_touched_partitions_only(spark, warehouse, rows, tmp_path):
    by_month = ("month", "substring(date, 1, 7)")
    warehouse.create_table("raw.months", DAYS, key=["date"], partition=by_month)
    first = spark.createDataFrame([("2024-01-01", 1), ("2024-02-01", 2), ("2024-02-02", 3)], DAYS)
    warehouse.upsert(first, "raw.months")

    def files():
        found = warehouse.read("raw.months").select("month", "_metadata.file_path").distinct()
        return {r["month"]: r["file_path"] for r in found.collect()}

    before = files()
    second = spark.createDataFrame([("2024-02-02", 30), ("2024-03-01", 4)], DAYS)
    warehouse.upsert(second, "raw.months")
    after = files()
    assert after["2024-01"] == before["2024-01"]
    assert after["2024-02"] != before["2024-02"]
    assert rows(warehouse.read("raw.months"), "date", "total") == [
        ("2024-01-01", 1), ("2024-02-01", 2), ("2024-02-02", 30), ("2024-03-01", 4),
    ]


def test_partition_values_with_quotes_and_null(spark, warehouse, rows):
    warehouse.create_table("raw.odd", DAYS, key=["date"], partition=("part", "concat(date, '\\'')"))
    warehouse.upsert(spark.createDataFrame([("it's", 1), ("a/b\\c", 2)], DAYS), "raw.odd")
    warehouse.upsert(spark.createDataFrame([("it's", 5), (None, 6)], DAYS), "raw.odd")
    assert rows(warehouse.read("raw.odd"), "date", "total") == [(None, 6), ("a/b\\c", 2), ("it's", 5)]


def test_partitioned_table_takes_every_write(spark, warehouse, rows):
    by_month = ("month", "substring(date, 1, 7)")
    warehouse.create_table("raw.p", DAYS, key=["date"], partition=by_month)
    warehouse.load(spark.createDataFrame([("2024-01-01", 1)], DAYS), "raw.p", "append")
    assert rows(warehouse.read("raw.p")) == [("2024-01-01", 1, "2024-01")]
    two = spark.createDataFrame([("2024-02-01", 2), ("2024-03-01", 3)], DAYS)
    assert warehouse.refresh(two, "raw.p") == 2
    assert rows(warehouse.read("raw.p"), "date", "month") == [
        ("2024-02-01", "2024-02"), ("2024-03-01", "2024-03"),
    ]
    warehouse.upsert(spark.createDataFrame([("2024-02-01", 9)], DAYS), "raw.p")
    assert rows(warehouse.read("raw.p"), "date", "total") == [("2024-02-01", 9), ("2024-03-01", 3)]
    assert warehouse.expire("raw.p") > 0
    assert warehouse.read("raw.p").count() == 2
    warehouse.truncate("raw.p")
    assert warehouse.read("raw.p").isEmpty()
    assert warehouse.key("raw.p") == ["date"]
    assert warehouse.definition("raw.p").partition == by_month
    assert warehouse.load(two, "raw.p", "replace") == 2
    assert warehouse.read("raw.p").columns == ["date", "total", "month"]
    assert warehouse.definition("raw.p").partition == by_month


def test_partition_must_follow_from_the_key(warehouse):
    with pytest.raises(AnalysisException):
        warehouse.create_table("raw.bad", DAYS, key=["date"], partition=("p", "total % 2"))


def test_overlay_equals_upsert(spark, rows):
    target = spark.createDataFrame([("d1", 1), ("d2", 2)], DAYS)
    staging = spark.createDataFrame([("d2", None), ("d3", 3)], DAYS)
    assert rows(overlay(target, staging, ["date"])) == [("d1", 1), ("d2", None), ("d3", 3)]


def test_refresh_first_run_takes_the_staging_schema(spark, warehouse, rows):
    assert warehouse.refresh(spark.createDataFrame([("d1", 1)], DAYS), "raw.fresh") == 1
    assert warehouse.read("raw.fresh").columns == ["date", "total"]
    assert rows(warehouse.read("raw.fresh")) == [("d1", 1)]


def test_refresh_leaves_no_old_rows_and_goes_by_name(spark, days, rows):
    days.refresh(spark.createDataFrame([(9, "d9")], "total bigint, date string"), "raw.days")
    assert rows(days.read("raw.days")) == [("d9", 9)]


def test_refresh_with_empty_staging_keeps_the_table(spark, days, rows):
    with pytest.raises(GateFailed, match="empty"):
        days.refresh(spark.createDataFrame([], DAYS), "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 2)]


@pytest.mark.parametrize("schema", ["date string", "date string, total bigint, more int"])
def test_refresh_with_other_columns_keeps_the_table(spark, days, rows, schema):
    row = ("d9", 9, 9)[: schema.count(",") + 1]
    with pytest.raises(ColumnMismatch):
        days.refresh(spark.createDataFrame([row], schema), "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 2)]


def test_refresh_from_its_own_rows(days, rows):
    days.refresh(days.read("raw.days").where("total > 1"), "raw.days")
    assert rows(days.read("raw.days")) == [("d2", 2)]


def test_failing_refresh_keeps_the_table(spark, days, rows):
    broken = days.read("raw.days").withColumn("total", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        days.refresh(broken, "raw.days")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 2)]


def test_load_modes(spark, warehouse, rows):
    one, two = (spark.createDataFrame([(f"d{i}", i)], DAYS) for i in (1, 2))
    assert warehouse.load(one, "raw.t", "fail") == 1
    with pytest.raises(ValueError, match="exists"):
        warehouse.load(two, "raw.t", "fail")
    assert warehouse.load(two.select("total", "date"), "raw.t", "append") == 1
    assert rows(warehouse.read("raw.t")) == [("d1", 1), ("d2", 2)]
    other = spark.createDataFrame([(1.5,)], "x double")
    assert warehouse.load(other, "raw.t", "replace") == 1
    assert rows(warehouse.read("raw.t")) == [(1.5,)]
    with pytest.raises(ColumnMismatch):
        warehouse.load(two, "raw.t", "append")
    with pytest.raises(ValueError, match="unknown mode"):
        warehouse.load(two, "raw.t", "merge")


def test_definitions_are_repeatable(warehouse, rows, spark):
    for _ in range(2):
        warehouse.create_database("raw")
        warehouse.create_table("raw.k", DAYS, key=["date"])
    assert warehouse.key("raw.k") == ["date"]
    warehouse.clone_schema("raw.copy", warehouse.read("raw.k"))
    assert warehouse.read("raw.copy").dtypes == [("date", "string"), ("total", "bigint")]
    warehouse.drop("raw.copy")
    warehouse.drop("raw.copy", strict=False)
    with pytest.raises(AnalysisException):
        warehouse.drop("raw.copy")


def test_truncate_keeps_the_definition(days, rows):
    days.truncate("raw.days")
    assert rows(days.read("raw.days")) == []
    assert days.key("raw.days") == ["date"]


def test_expire_keeps_the_current_content(spark, days, rows):
    for i in range(3):
        days.refresh(spark.createDataFrame([("d", i)], DAYS), "raw.days")
    assert days.expire("raw.days", keep=2) >= 1
    assert rows(days.read("raw.days")) == [("d", 2)]
    assert days.expire("raw.days", keep=2) == 0


def test_latest_per_key_breaks_ties_by_the_other_columns(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "q")], "k string, t int, v string")
    assert rows(latest_per_key(df, ["k"], ["t"])) == [("a", 2, "z"), ("b", 1, "q")]


def publish_steps(warehouse):
    """Each way to change the content of a table, by name."""
    spark = warehouse.spark
    new = spark.createDataFrame([("2024-01-09", 9), ("2024-02-09", 9)], DAYS)
    return {
        "refresh": lambda: warehouse.refresh(new, "raw.t"),
        "truncate": lambda: warehouse.truncate("raw.t"),
        "upsert": lambda: warehouse.upsert(new, "raw.t"),
        "replace": lambda: warehouse.load(new, "raw.t", "replace"),
    }


@pytest.mark.parametrize("partition", [None, ("month", "substring(date, 1, 7)")])
@pytest.mark.parametrize("step", ["refresh", "truncate", "upsert", "replace"])
def test_a_failure_at_any_step_leaves_the_old_rows(spark, warehouse, rows, monkeypatch, partition, step):
    warehouse.create_table("raw.t", DAYS, key=["date"], partition=partition)
    warehouse.upsert(spark.createDataFrame([("2024-01-01", 1), ("2024-02-01", 2)], DAYS), "raw.t")
    before = rows(warehouse.read("raw.t"))
    run_sql, at = spark.sql, 0
    while True:
        calls = 0

        def failing(text, *args, **kwargs):
            nonlocal calls
            if text.lstrip().startswith(("CREATE", "ALTER", "DROP")):
                calls += 1
                if calls > at:
                    raise OSError("injected")
            # Readers see the table at every statement.
            assert rows(run_sql(f"SELECT * FROM {warehouse.full_name('raw.t')}")) == before
            return run_sql(text, *args, **kwargs)

        monkeypatch.setattr(spark, "sql", failing)
        try:
            publish_steps(warehouse)[step]()
            break
        except OSError:
            at += 1
        finally:
            monkeypatch.setattr(spark, "sql", run_sql)
        assert rows(warehouse.read("raw.t")) == before
    assert at >= 2
    assert rows(warehouse.read("raw.t")) != before


def test_many_touched_partitions_rewrite_only_those(spark, warehouse, monkeypatch):
    monkeypatch.setattr("tidemark.sinks.tables.PARTITIONS_PER_STATEMENT", 7)
    warehouse.create_table("raw.many", DAYS, key=["date"], partition=("part", "date"))
    warehouse.upsert(spark.range(40).selectExpr("CAST(id AS STRING) AS date", "id AS total"), "raw.many")

    def files():
        found = warehouse.read("raw.many").select("part", "_metadata.file_path").distinct()
        return {r["part"]: r["file_path"] for r in found.collect()}

    before = files()
    warehouse.upsert(spark.range(10, 45).selectExpr("CAST(id AS STRING) AS date", "-id AS total"), "raw.many")
    after = files()
    assert len(after) == 45
    assert {p for p in before if before[p] == after[p]} == {str(i) for i in range(10)}
    assert warehouse.read("raw.many").agg(F.sum("total")).first()[0] == sum(range(10)) - sum(range(10, 45))


def test_partition_filters_reach_the_scan(spark, warehouse):
    warehouse.create_table("raw.f", DAYS, key=["date"], partition=("part", "date"))
    warehouse.upsert(spark.createDataFrame([("a", 1), ("b", 2)], DAYS), "raw.f")
    for frame in (warehouse.read("raw.f"), spark.table(warehouse.full_name("raw.f"))):
        plan = frame.where("part = 'a'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(part" in plan


def test_a_read_keeps_its_rows_after_later_writes(spark, days, rows):
    held = days.read("raw.days")
    days.refresh(spark.createDataFrame([("d9", 9)], DAYS), "raw.days")
    assert rows(held) == [("d1", 1), ("d2", 2)]


@pytest.mark.parametrize("partition", [None, ("part", "substr(date, 1, 1)")])
def test_a_read_keeps_its_rows_after_appends(spark, warehouse, rows, partition):
    warehouse.create_table("raw.kept", DAYS, key=["date"], partition=partition)
    versions = len(warehouse._versions("raw.kept"))
    held = []
    for k in range(4):
        warehouse.load(spark.createDataFrame([(f"d{k}", k), (f"{k}d", k)], DAYS), "raw.kept", "append")
        held.append(warehouse.read("raw.kept"))
    assert [df.count() for df in held] == [2, 4, 6, 8]
    assert len(warehouse._versions("raw.kept")) == versions + 4
    assert held[0].columns == ["date", "total", *(["part"] if partition else [])]
    assert warehouse.spark.table(warehouse.full_name("raw.kept")).count() == 8
    warehouse.expire("raw.kept", keep=1)
    assert held[3].count() == 8


def test_an_append_writes_its_own_rows_only(spark, warehouse):
    warehouse.load(spark.range(1000).selectExpr("id", "'a' AS t"), "raw.log")
    before = set(warehouse._partition_folders(warehouse._versions("raw.log")[-1]))
    warehouse.load(spark.range(5).selectExpr("id", "'b' AS t"), "raw.log", "append")
    after = set(warehouse._partition_folders(warehouse._versions("raw.log")[-1]))
    assert before < after and len(after) == len(before) + 1
    assert spark.read.parquet((after - before).pop()).count() == 5
    assert warehouse.load(spark.range(0).selectExpr("id", "'c' AS t"), "raw.log", "append") == 0
    assert warehouse.read("raw.log").count() == 1005


def statements(spark, run):
    """How many SQL statements ``run`` sends."""
    sent, plain = [], type(spark).sql
    type(spark).sql = lambda self, text, *args, **kwargs: sent.append(text) or plain(self, text, *args, **kwargs)
    try:
        run()
    finally:
        type(spark).sql = plain
    return sent


def test_statements_follow_the_change_not_the_table(spark, warehouse):
    sent = {}
    for n in (3, 1000):
        name = f"raw.p{n}"
        warehouse.create_table(name, "id bigint, v bigint", key=["id"], partition=("part", "id"))
        warehouse.load(spark.range(n).selectExpr("id", "id AS v"), name)
        staged = spark.createDataFrame([(1, -1), (n, -2)], "id bigint, v bigint")
        sent[n] = statements(spark, lambda staged=staged, name=name: warehouse.upsert(staged, name))
        assert warehouse.read(name).where("v < 0").count() == 2 and warehouse.read(name).count() == n + 1
    assert len(sent[3]) == len(sent[1000])
    assert max(map(len, sent[1000])) < 1.2 * max(map(len, sent[3]))


def test_an_upsert_writes_the_buckets_of_its_keys(spark, warehouse):
    warehouse.create_table("raw.ids", "id bigint, v bigint", key=["id"], buckets=64)
    warehouse.upsert(spark.range(20_000).selectExpr("id", "id AS v"), "raw.ids")
    old = set(warehouse._partition_folders(warehouse._versions("raw.ids")[-1]))
    staged = spark.createDataFrame([(7, -1), (7_000_000, -2), (None, -3)], "id bigint, v bigint")
    warehouse.upsert(staged, "raw.ids")
    new = set(warehouse._partition_folders(warehouse._versions("raw.ids")[-1]))
    assert len(old) == len(new) == 64 and 1 <= len(new - old) <= 3
    found = warehouse.read("raw.ids")
    assert found.count() == 20_002 and sorted(r["v"] for r in found.where("v < 0").collect()) == [-3, -2, -1]
    with pytest.raises(ValueError, match="buckets need a key"):
        warehouse.create_table("raw.none", "id bigint", buckets=4)


def test_declared_keys_stay_unique(spark, days, rows):
    twice = spark.createDataFrame([("k", 1), ("k", 2)], DAYS)
    for how in (lambda: days.refresh(twice, "raw.days"), lambda: days.load(twice, "raw.days", "append"), lambda: days.load(twice, "raw.days")):
        with pytest.raises(GateFailed, match="more than once"):
            how()
    with pytest.raises(GateFailed, match="there already"):
        days.load(spark.createDataFrame([("d2", 5)], DAYS), "raw.days", "append")
    assert rows(days.read("raw.days")) == [("d1", 1), ("d2", 2)]
    days.load(spark.createDataFrame([(None, 5), (None, 6)], DAYS), "raw.days", "append")
    assert days.read("raw.days").count() == 4


def test_append_into_old_and_new_partitions(spark, warehouse, rows):
    warehouse.create_table("raw.a", DAYS, key=["date"], partition=("part", "substr(date, 1, 1)"))
    warehouse.upsert(spark.createDataFrame([("a1", 1), ("b1", 2)], DAYS), "raw.a")
    warehouse.load(spark.createDataFrame([("a2", 3), ("c/1", 4), (None, 5)], DAYS), "raw.a", "append")
    warehouse.upsert(spark.createDataFrame([("c/1", 40), ("a1", 10)], DAYS), "raw.a")
    assert rows(warehouse.read("raw.a"), "date", "total") == [(None, 5), ("a1", 10), ("a2", 3), ("b1", 2), ("c/1", 40)]
    warehouse.expire("raw.a", keep=1)
    assert rows(warehouse.read("raw.a"), "date", "total") == [(None, 5), ("a1", 10), ("a2", 3), ("b1", 2), ("c/1", 40)]


def test_odd_column_names(spark, warehouse, rows):
    inner = spark.sql("SELECT named_struct('content-type', 'x', 'Location', 1) AS Location")
    warehouse.load(inner, "raw.inner")
    assert warehouse.read("raw.inner").select("Location.`content-type`").first()[0] == "x"
    assert warehouse.location("raw.inner").startswith(warehouse.root)
    warehouse.create_table("raw.dotted", "`a.b` string, v int", key=["a.b"])
    for v in (1, 2):
        warehouse.upsert(spark.createDataFrame([("k", v)], "`a.b` string, v int"), "raw.dotted")
    assert rows(warehouse.read("raw.dotted")) == [("k", 2)]
