from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    deletion_variants,
    fill_template,
    normalise_text,
    seconds_between,
    template_fields,
)
from tidemark.operators.fuzzy import match_names, match_token_sets
from tidemark.operators.merge import union_by_name
from tidemark.operators.quality import Check, GateFailed, check_report, require_valid, row_counts
from tidemark.operators.shape import as_text, explode_parallel, flatten
from tidemark.operators.summary import daily_summary, hourly
from tidemark.plans import marts
from tidemark.plans.catalog import KEYED_TABLES, WEATHER_DOCUMENT


def test_flatten_gives_the_weather_columns(spark):
    flat = flatten(spark.createDataFrame([], WEATHER_DOCUMENT))
    columns, _ = KEYED_TABLES["raw.openweather_daily"]
    assert flat.columns == [c.split()[0] for c in columns.split(", ")]


def test_flatten_refuses_a_clash(spark):
    df = spark.createDataFrame([], "a struct<b: int>, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        flatten(df)


def test_flatten_null_struct(spark, rows):
    df = spark.createDataFrame([(1, None), (2, (3,))], "id int, s struct<x: int>")
    assert rows(flatten(df)) == [(1, None), (2, 3)]


def test_explode_parallel_pads_the_shorter(spark, rows):
    df = spark.createDataFrame([("d", ["a", "b"], [1.0]), ("e", [], [])], "date string, time array<string>, energy array<double>")
    out = explode_parallel(df, time="time", energy="energy")
    assert rows(out) == [("d", "a", 1.0), ("d", "b", None)]


def test_union_fills_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n bigint, t string")
    b = spark.createDataFrame([("y",)], "t string")
    out = union_by_name([a, b])
    assert rows(out) == [(None, "y"), (1, "x")]
    assert dict(out.dtypes)["n"] == "bigint"


def test_as_text(spark, rows):
    df = spark.createDataFrame([(1, 0.5, True, None)], "a int, b double, c boolean, d int")
    assert rows(as_text(df)) == [("1", "0.5", "true", None)]


def test_template(spark, rows):
    assert template_fields("{a}/x/{b}") == ["a", "b"]
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows(df.select(fill_template("{a}-x"), fill_template("{b}-x"))) == [("1-x", None)]


def test_normalise_text(spark, rows):
    df = spark.createDataFrame([("  São  JOÃO\n d’Óca ",), ("été",), (None,)], "t string")
    assert rows(df.select(normalise_text(F.col("t")))) == [(None,), ("ete",), ("sao joao d’oca",)]


def test_hourly_and_daily(spark, rows):
    df = spark.createDataFrame(
        [("2024-01-01 00:10:00", 1.0), ("2024-01-01 00:50:00", 2.0), ("2024-01-01 13:00:00", 4.0), (None, 9.0)],
        "t string, v double",
    ).select(F.col("t").cast("timestamp_ntz").alias("ts"), "v")
    assert rows(hourly(df, "ts", "v")) == [("2024-01-01 00:00:00", 3.0), ("2024-01-01 13:00:00", 4.0)]
    assert rows(hourly(df, "ts", "v", F.max)) == [("2024-01-01 00:00:00", 2.0), ("2024-01-01 13:00:00", 4.0)]
    assert rows(daily_summary(df, "ts", "v")) == [("2024-01-01", 46200, 7.0, None, 4.0)]


def test_times_do_not_depend_on_the_session_zone(spark, rows):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        # At this midnight the clocks of that zone went forward by an hour.
        df = spark.sql("SELECT timestamp_ntz'2018-11-04 00:30:00' AS ts, 1.0D AS v")
        assert rows(hourly(df, "ts", "v")) == [("2018-11-04 00:00:00", 1.0)]
        span = spark.sql("SELECT timestamp_ntz'2018-11-03 00:00:00' a, timestamp_ntz'2018-11-05 00:00:00' b")
        assert rows(span.select(seconds_between(F.col("a"), F.col("b")))) == [(172800,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def edits(a: str, b: str) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


@pytest.mark.parametrize("distance", [1, 2])
def test_match_names_equals_brute_force(spark, distance):
    words = ["".join(p) for n in range(4) for p in itertools.product("ab", repeat=n)]
    left, right = words + ["abcd", "aab"], words[::2] + ["abdc", "xaab"]
    found = match_names(
        spark.createDataFrame([(w,) for w in left], "n string"), F.col("n"),
        spark.createDataFrame([(w,) for w in right] + [(None,)], "n string"), F.col("n"), distance,
    ).collect()
    expected = {(a, b, edits(a, b)) for a in left for b in right if edits(a, b) <= distance}
    assert {(r["left_name"], r["right_name"], r["distance"]) for r in found} == expected
    assert len(found) == len(expected)
    assert {r["left_rows"] for r in found if r["left_name"] == "aab"} == {2}


def test_deletion_variants(spark):
    row = spark.range(1).select(deletion_variants(F.lit("abc"), 1).alias("v")).first()
    assert sorted(row["v"]) == ["ab", "abc", "ac", "bc"]


def test_check_report(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", "x1", 5), (1, "b", "y", -1), (2, None, "x2", None)], "id int, s string, t string, n int"
    )
    checks = [
        Check("present", "id"), Check("present", "gone"), Check("not_null", "s"), Check("unique", "id"),
        Check("in_set", "s", ["a"]), Check("range", "n", (0, 3)), Check("regex", "t", "^x"),
        Check("type", "t", "int"), Check("not_null", "gone"),
    ]
    got = {(c, k): n for c, k, n in rows(check_report(df, checks))}
    assert got == {
        ("present", "id"): 0, ("present", "gone"): 1, ("not_null", "s"): 1, ("unique", "id"): 1,
        ("in_set", "s"): 1, ("range", "n"): 2, ("regex", "t"): 1, ("type", "t"): 3, ("not_null", "gone"): 3,
    }
    with pytest.raises(GateFailed, match=r"unique\(id\): 1"):
        require_valid(df, checks)
    assert require_valid(df, [Check("not_null", "id")]) is df
    with pytest.raises(ValueError, match="unknown check"):
        check_report(df, [Check("odd", "id")])


def test_row_counts(spark, rows):
    assert rows(row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


def test_top_ranked_cuts_ties_by_id(spark, rows):
    df = spark.createDataFrame([(3, 5.0), (1, 5.0), (2, 5.0), (4, 9.0)], "id int, score double")
    assert rows(marts.top_ranked(df, "score", "id", 3), "id", "rank") == [(1, 2), (2, 2), (4, 1)]


def test_include_related_keeps_unmatched(spark, rows):
    top = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, state int")
    states = spark.createDataFrame([(10, "SP", 7), (11, "RJ", 7)], "code int, name string, region int")
    regions = spark.createDataFrame([(7, "SE")], "rid int, rname string")
    out = marts.include_related(top, {"state": (states, "code"), "region": (regions, "rid")})
    assert rows(out, "id", "name", "rname") == [(1, "SP", "SE"), (2, None, None), (3, None, None)]


def test_rates_without_votes(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", True), ("b", False), ("b", None)], "who string, yes boolean")
    assert rows(marts.alignment_rate(df, "who", F.col("yes"))) == [("a", 0, 0, None), ("b", 2, 1, 0.5)]


def likely_names(seed, n):
    chance = random.Random(seed)
    words = ["da", "de", "silva", "souza", "ana", "maria", "jose", "lima", "x", "é"]
    return [" ".join(chance.choices(words, k=chance.randrange(0, 7))) for _ in range(n)] + [None, "", "  ", " ana  lima "]


@pytest.mark.parametrize("percent", [20, 50, 80, 100])
def test_token_sets(spark, percent):
    sides = likely_names(1, 80), likely_names(2, 80)
    left, right = (spark.createDataFrame([(x,) for x in side], "name string") for side in sides)
    found = {
        (r["left_name"], r["right_name"]): (r["left_rows"], r["right_rows"], r["common"], r["total"])
        for r in match_token_sets(left, F.col("name"), right, F.col("name"), percent).collect()
    }
    want = {}
    for a in filter(None, set(sides[0])):
        for b in filter(None, set(sides[1])):
            x, y = set(a.split()), set(b.split())
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                want[a, b] = (sides[0].count(a), sides[1].count(b), len(x & y), len(x | y))
    assert found == want and want


def test_many_uniqueness_rules_are_one_scan(spark, tmp_path):
    values = ", ".join(f"id % {k + 1} AS c{k}" for k in range(18))
    spark.sql(f"SELECT CAST(nullif(id, 5) AS DOUBLE) * -1 AS d, array(id % 3, NULL) AS a, {values} FROM range(60)").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = check_report(df, [Check("unique", c) for c in df.columns])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2  # of the values, and of the row rules' count
    found = {r["column"]: r["n_bad"] for r in report.collect()}
    assert found == {"d": 0, "a": 57, **{f"c{k}": 60 - min(60, k + 1) for k in range(18)}}


def test_uniqueness_of_values_that_look_alike(spark):
    rows = [(0.0, b"\x00", "1"), (-0.0, b"\x01", "1 "), (None, None, None), (None, b"\xff", None), (float("nan"), b"\xfe", "é"), (float("nan"), b"", "e")]
    df = spark.createDataFrame(rows, "d double, b binary, s string")
    found = {r["column"]: r["n_bad"] for r in check_report(df, [Check("unique", c) for c in "dbs"]).collect()}
    assert found == {"d": 2, "b": 0, "s": 0}
