from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources.files import (
    infer_types,
    list_files,
    read_binary_documents,
    read_csv_dir,
    read_documents,
    read_json_dir,
    read_latest_partition,
    read_rejects,
    read_text_csv,
    read_typed_csv,
)
from tidemark.sources.html import links, page_title
from tidemark.sources.tables import read_jdbc, scalar_row


def test_text_csv_keeps_cells_and_nulls_missing_tokens(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_text('code,day,note\n007,2024-01-02,NA\n1.0,,None\nnull,x,""\n')
    df = read_text_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["string"] * 3
    assert rows(df) == [(None, "x", None), ("007", "2024-01-02", None), ("1.0", None, None)]


def test_text_csv_keeps_line_breaks_and_quotes(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_text('id,text\n1,"two\nlines, with ""quotes"""\n')
    assert rows(read_text_csv(spark, str(path))) == [("1", 'two\nlines, with "quotes"')]


def test_typed_csv_with_and_without_schema(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_text("id;rate;ok;name\n1;0.5;True;x\n2;NA;False;7d\n")
    found = read_typed_csv(spark, str(path))
    assert found.dtypes == [("id", "bigint"), ("rate", "double"), ("ok", "boolean"), ("name", "string")]
    assert rows(found) == [(1, 0.5, True, "x"), (2, None, False, "7d")]
    declared = read_typed_csv(spark, str(path), "id int, rate double, ok boolean, name string")
    assert rows(declared, "id", "rate") == [(1, 0.5), (2, None)]


def test_typed_csv_with_a_misfit_raises(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id\n1\nx\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_typed_csv(spark, str(path), "id int").collect()


def test_infer_types_of_edge_texts(spark):
    df = spark.createDataFrame(
        [("1d", "1e3", "9223372036854775808", None, "+5"), ("2f", ".5", "1", None, " 7 ")],
        "a string, b string, c string, d string, e string",
    )
    types = dict(infer_types(df).dtypes)
    assert types == {"a": "string", "b": "double", "c": "double", "d": "string", "e": "bigint"}


def test_csv_dir_aligns_headers_and_names_files(spark, tmp_path, rows):
    (tmp_path / "a.CSV").write_text("x;y\n1;2\n")
    (tmp_path / "b 1+c.csv").write_text("\ny;x;z\n20;10;q\n")
    (tmp_path / "d.csv").write_text("x;y\n100;200\n")
    (tmp_path / "e.txt").write_text("x;y\n7;7\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "f.csv").write_text("x;y\n8;8\n")
    df = read_csv_dir(spark, str(tmp_path))
    assert rows(df, "x", "y", "z", "source_filename") == [
        (1, 2, None, "a.CSV"),
        (10, 20, "q", "b 1+c.csv"),
        (100, 200, None, "d.csv"),
    ]


def test_csv_dir_types_hold_over_all_files(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.csv").write_text("x;y\nn/a;1\nword;2\n")
    df = read_csv_dir(spark, str(tmp_path))
    assert rows(df, "x", "y") == [(None, 1), ("1", None), ("word", 2)]


def test_empty_directories_give_none(spark, tmp_path):
    empty = str(tmp_path)
    assert read_csv_dir(spark, empty) is None
    assert read_json_dir(spark, empty) is None
    assert read_documents(spark, empty) is None
    assert read_binary_documents(spark, empty) is None
    assert list_files(spark, empty, "json") is None


def test_json_dir_unions_fields(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    (tmp_path / "b.JSON").write_text(json.dumps([{"b": "x"}]))
    (tmp_path / "c.json").write_text(json.dumps({"a": 3, "b": "y"}, indent=1))
    df = read_json_dir(spark, str(tmp_path))
    assert rows(df, "a", "b", "source_filename") == [
        (None, "x", "b.JSON"), (1, None, "a.json"), (2, None, "a.json"), (3, "y", "c.json"),
    ]


def test_documents_keep_a_corrupt_file(spark, tmp_path, rows):
    (tmp_path / "game_1.json").write_text('{"id": 1,\n "list": [1, 2]}')
    (tmp_path / "game_2.json").write_text("{bad")
    (tmp_path / "other.json").write_text('{"id": 3}')
    df = read_documents(spark, str(tmp_path), "game_*.json")
    picked = df.selectExpr("source_filename", "variant_get(payload, '$.list[1]', 'int') AS v", "raw")
    assert rows(picked) == [("game_1.json", 2, None), ("game_2.json", None, "{bad")]


def test_binary_documents_match_the_suffix_in_case(spark, tmp_path, rows):
    (tmp_path / "a.json").write_bytes(b"\x00\x01")
    (tmp_path / "b.JSON").write_bytes(b"x")
    found = [(r["file_name"], bytes(r["content"])) for r in read_binary_documents(spark, str(tmp_path)).collect()]
    assert found == [("a.json", b"\x00\x01")]


def test_latest_partition_by_name(spark, tmp_path, rows):
    base = str(tmp_path / "log")
    schema = "id int, season string"
    data = [(1, "20232024"), (2, "20242025"), (3, "20242025")]
    spark.createDataFrame(data, schema).write.partitionBy("season").parquet(base)
    df = read_latest_partition(spark, base, "season", schema)
    assert rows(df) == [(2, "20242025"), (3, "20242025")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan


def test_latest_partition_of_json_documents(spark, tmp_path, rows):
    base = tmp_path / "log"
    for season, text in (("20232024", "{bad"), ("20242025", '[{"id": 2}, {"id": 3}]'), ("20241", '{"id": 9}')):
        (base / f"season={season}").mkdir(parents=True)
        (base / f"season={season}" / "a.json").write_text(text)
    (base / "season=20242025" / "b.json").write_text("{bad")
    schema, rejects = "id int, season string", str(tmp_path / "rejects")
    with pytest.raises(Exception, match="bad record in b.json"):
        read_latest_partition(spark, str(base), "season", schema, file_format="json").collect()
    df = read_latest_partition(spark, str(base), "season", schema, file_format="json", rejects=rejects)
    assert rows(df) == [(2, "20242025"), (3, "20242025")]
    assert read_latest_partition(spark, str(tmp_path / "none"), "season", schema, file_format="json").count() == 0
    with pytest.raises(ValueError, match="unknown format"):
        read_latest_partition(spark, str(base), "season", schema, file_format="xml")


def test_latest_partition_without_any(spark, tmp_path):
    df = read_latest_partition(spark, str(tmp_path / "none"), "season", "id int, season string")
    assert df.count() == 0


def test_links(spark, rows):
    page = """<!-- <a href="/no">no</a> --><script>x='<a href="/no">n</a>'</script>
    <A class="c" HREF='/one?a=1&amp;b=2'><b>One</b> &lt;1&gt;</A><a href="/two">
    Two</a><a name="x">none</a>"""
    df = spark.createDataFrame([(1, page), (2, "no links")], "id int, html string")
    assert rows(links(df)) == [(1, 0, "/one?a=1&b=2", "One <1>"), (1, 1, "/two", "Two")]


def test_scalar_row(spark):
    assert scalar_row(spark, "SELECT 1 AS one")["one"] == 1
    assert scalar_row(spark, "SELECT 1 WHERE false") is None


def test_jdbc_arguments_are_checked(spark):
    with pytest.raises(ValueError, match="table or a query"):
        read_jdbc(spark, "jdbc:none:x")
    with pytest.raises(ValueError, match="needs bounds"):
        read_jdbc(spark, "jdbc:none:x", "t", split_by="id")
    with pytest.raises(ValueError, match="at least two partitions"):
        read_jdbc(spark, "jdbc:none:x", "t", split_by="id", bounds=(0, 9))


def test_links_written_in_every_way(spark, rows):
    page = """<A class=x href="/it's">it's</a><a data-href="/w" href='/r"q'>r</a>
<a title="a > b href='no'" href=/u>u</A ><a href = "/sp ace"
 >multi
line</a><a name="n">no target</a><!-- <a href="/hidden">h</a> --><area href="/area">
<a href="/?a=1&amp;amp;b=&eacute;&nbsp;&#233;&#xE9;&#8364;&unknown;&#0;">&lt;b&gt; &Eacute;</a>"""
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "id int, html string")
    assert [r[2:] for r in rows(links(df))] == [
        ("/it's", "it's"),
        ('/r"q', "r"),
        ("/u", "u"),
        ("/sp ace", "multi\nline"),
        ("/?a=1&amp;b=é\xa0éé€&unknown;&#0;", "<b> É"),
    ]


def test_long_tags_and_broken_pages(spark, rows):
    many = 100_000
    pages = [
        f"<a x{'y' * many} href=/bare>1</a>",
        f"<a title=\"{'> ' * many}\" href='/quoted'>2</a>",
        f"<a {'q=\"v\" ' * (many // 6)}href=/many>3</a>",
        f"<a href=/value{'z' * many}>4</a>",
        f"<a href=/text>{'<b> ' * (many // 4)}5</a>",
        # None of these may take time that grows with the square of the length.
        "<a href=/open>" * (many // 14) + "6",
        "<!-- " * (many // 5),
        "<script " * (many // 8),
        "<a " * (many // 3),
        "<a href=/space>" + "7" + " " * many + "8</a>",
        "<" * many,
        "<title " * (many // 7),
        '<a "' * (many // 4),
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    found = rows(links(df).where("id <> 5"), "id", "label", F.substring("href", 1, 9))
    assert found == [
        (0, "1", "/bare"), (1, "2", "/quoted"), (2, "3", "/many"), (3, "4", "/valuezzz"), (4, "5", "/text"),
        (9, "7" + " " * many + "8", "/space"),
    ]
    unclosed = links(df).where("id = 5").agg(F.count("*"), F.max("position"), F.max_by("label", "position")).first()
    assert tuple(unclosed) == (many // 14, many // 14 - 1, "6")
    assert df.where(page_title("html") != "").count() == 0


def test_an_anchor_ends_where_another_begins(spark, rows):
    df = spark.createDataFrame([(1, "<a href=/1>one <A\nHREF=/2>two<abbr>!</abbr></a> x < y <a name=n>")], "id int, html string")
    assert rows(links(df), "href", "label") == [("/1", "one"), ("/2", "two!")]


def test_title_outside_comments(spark, rows):
    page = "<!-- <title>old</title> --><title lang=pt>\n Não &amp;lt; </title><title>second</title>"
    df = spark.createDataFrame([(page,), ("none",)], "html string")
    assert rows(df.select(page_title("html"))) == [("",), ("Não &lt;",)]


def test_surplus_cells_are_not_lost(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('a;b\n1;2\n1;2;3\n4\n"x;y";"p;""q"\n"l;1";2;""\n')
    path, rejects = str(tmp_path / "a.csv"), str(tmp_path / "rejects")
    with pytest.raises(Exception, match="bad record in a.csv: 1;2;3"):
        read_text_csv(spark, path, ";").collect()
    for multi_line in (True, False):
        good = read_text_csv(spark, path, ";", multi_line=multi_line, rejects=rejects)
        assert rows(good) == [("1", "2"), ("4", None), ("x;y", 'p;"q')]
    assert rows(read_rejects(spark, rejects), "source_filename") == [("a.csv",)] * 4
    typed = read_csv_dir(spark, str(tmp_path), schema="a string, b string, c int", one_header=True, rejects=rejects)
    assert rows(typed, "a", "c", "source_filename") == [("1", None, "a.csv"), ("4", None, "a.csv"), ("x;y", None, "a.csv")]


@pytest.mark.parametrize("schema", [None, "a int"])
def test_corrupt_json_is_not_lost(spark, tmp_path, rows, schema):
    (tmp_path / "good.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "bad.json").write_text("{bad")
    rejects = str(tmp_path / "rejects")
    with pytest.raises(Exception, match="bad record in bad.json"):
        read_json_dir(spark, str(tmp_path), schema).collect()
    good = read_json_dir(spark, str(tmp_path), schema, rejects=rejects)
    assert rows(good) == [(1, "good.json"), (2, "good.json")]
    assert rows(read_rejects(spark, rejects)) == [("bad.json", "{bad")]


@pytest.mark.parametrize("multi_line", [True, False])
def test_long_quoted_cells_in_short_and_surplus_lines(spark, tmp_path, rows, multi_line):
    long = 'x;""y""' * 150_000
    lines = ["a;b;c", f'1;"{long}"', f'2;"{long}";3;4', f'"{long}";5;6', 'q"u;o"t;e', 'p"q;r']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    rejects = str(tmp_path / "rejects")
    found = read_text_csv(spark, str(tmp_path / "a.csv"), ";", multi_line=multi_line, rejects=rejects)
    cell = long.replace('""', '"')
    assert rows(found) == sorted([("1", cell, None), (cell, "5", "6"), ('q"u', 'o"t', "e"), ('p"q', "r", None)], key=lambda r: [(v is not None, str(v)) for v in r])
    assert [r["record"][:2] for r in read_rejects(spark, rejects).collect()] == ["2;"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_fifty_headers_in_one_scan(spark, tmp_path, rows, multi_line):
    for k in range(50):
        names = ["id", f"only_{k}", *(["note"] if k % 2 else [])]
        (tmp_path / f"f{k}.csv").write_text(";".join(reversed(names)) + "\n" + ";".join(reversed([str(k), f"v{k}", "n"][: len(names)])) + "\n")
    df = read_csv_dir(spark, str(tmp_path), multi_line=multi_line)
    assert set(df.columns) == {"id", "note", "source_filename", *(f"only_{k}" for k in range(50))}
    for k in (0, 1, 49):
        assert rows(df.where(f"id = {k}"), "id", "note", f"only_{k}", "only_7", "source_filename") == [
            (k, "n" if k % 2 else None, f"v{k}", None, f"f{k}.csv")
        ]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") - plan.count("parquet") == 1 and plan.count(" csv") == 1


def test_mixed_headers_with_odd_names_and_lines(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('a;"b;x";;A\n1;2;3;4\n5;"p\nq"\n')
    (tmp_path / "b.csv").write_text("B;a0\n1;2\n1;2;3\n")
    rejects = str(tmp_path / "rejects")
    df = read_csv_dir(spark, str(tmp_path), rejects=rejects)
    assert df.columns == ["B", "a0", "b;x", "_c2", "A3", "source_filename"]
    assert rows(df) == [
        (None, 1, "2", 3, 4, "a.csv"), (None, 5, "p\nq", None, None, "a.csv"), (1, 2, None, None, None, "b.csv"),
    ]
    assert rows(read_rejects(spark, rejects)) == [("b.csv", "1;2;3")]
