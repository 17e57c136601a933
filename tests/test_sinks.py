from __future__ import annotations

import glob

import pytest

from tidemark.sinks.archive import archive_documents, move_loaded_files, unloaded_files
from tidemark.sinks.export import ExportFailed, export_all, export_csv, export_query
from tidemark.sources.files import list_files, read_binary_documents


def written(path) -> str:
    return "".join(open(f, newline="").read() for f in sorted(glob.glob(f"{path}/part-*")))


def test_csv_export_format(spark, tmp_path):
    df = spark.sql(
        "SELECT 1 AS id, CAST(NULL AS string) AS a, '' AS b, 'x;y' AS c, 'say \"hi\"' AS d, true AS e, "
        "timestamp_ntz'2024-01-02 03:04:05' AS f, ' pad ' AS g, 1.5D AS h, "
        "timestamp'2024-01-02 03:04:05.123456' AS i"
    )
    path = export_csv(df, str(tmp_path / "t.csv"))
    assert written(path) == (
        'id;a;b;c;d;e;f;g;h;i\n1;;;"x;y";"say ""hi""";True;2024-01-02 03:04:05; pad ;1.5;'
        "2024-01-02 03:04:05.123456\n"
    )


def test_export_replaces_and_takes_queries(spark, tmp_path):
    path = str(tmp_path / "q.csv")
    export_query(spark, "SELECT 1 AS a, 2 AS b", path)
    export_query(spark, "SELECT 3 AS a, 4 AS b", path)
    assert written(path) == "a,b\n3,4\n"


def test_one_bad_table_leaves_the_rest(spark, tmp_path):
    def absent():
        return spark.table("marts.absent")

    tables = {"a": lambda: spark.range(2), "bad": absent, "c": lambda: spark.range(3)}
    with pytest.raises(ExportFailed, match="bad") as failure:
        export_all(spark, tables, str(tmp_path))
    counts = {name: n for name, n, _, _ in failure.value.report}
    assert counts == {"a": 2, "bad": None, "c": 3}
    assert written(tmp_path / "c.csv").count("\n") >= 4


def test_archive_takes_the_suffix_and_replaces_a_key(spark, warehouse, tmp_path, rows):
    (tmp_path / "a.json").write_text("one")
    (tmp_path / "b.JSON").write_text("other case")
    (tmp_path / "c.csv").write_text("other type")
    archive_documents(read_binary_documents(spark, str(tmp_path)), warehouse, "raw.archive")
    again = spark.createDataFrame([("a.json", "two"), ("d/e.json", "new"), ("f.txt", "no")], "file_name string, content string")
    archive_documents(again, warehouse, "raw.archive")
    stored = warehouse.read("raw.archive").selectExpr("key", "length", "cast(content AS string)")
    assert rows(stored) == [("bronze/a.json", 3, "two"), ("bronze/d/e.json", 3, "new")]


def test_archive_without_folders(spark, warehouse, rows):
    for text in ("one", "two"):
        sent = spark.createDataFrame([("a.json", text)], "file_name string, content string")
        archive_documents(sent, warehouse, "raw.flat", prefix="")
    stored = warehouse.read("raw.flat").selectExpr("key", "cast(content AS string)", "folder")
    # Flat names are dealt by a hash of the key.
    assert rows(stored) == [("a.json", "two", "/e5")]


def test_archive_computes_its_source_once(spark, warehouse):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    sent = spark.createDataFrame([(f"{k}.json", "x") for k in range(40)], "file_name string, content string")
    archive_documents(sent.mapInArrow(count, sent.schema), warehouse, "raw.once", digits=1)
    assert seen.value == 40
    assert warehouse.read("raw.once").select("folder").distinct().count() <= 16


@pytest.mark.parametrize("with_json", [True, False])
def test_loaded_files_are_moved_and_csv_removed(spark, tmp_path, with_json):
    staging, bronze = tmp_path / "staging", tmp_path / "bronze"
    staging.mkdir()
    if with_json:
        (staging / "a b.json").write_text("new")
        bronze.mkdir()
        (bronze / "a b.json").write_text("old")
    (staging / "x.csv").write_text("1")
    (staging / "keep.txt").write_text("1")
    assert move_loaded_files(spark, str(staging), str(bronze)) == int(with_json)
    assert sorted(p.name for p in staging.iterdir() if not p.name.startswith(".")) == ["keep.txt"]
    if with_json:
        assert (bronze / "a b.json").read_text() == "new"


def test_unloaded_files(spark, tmp_path, rows):
    for name in ("a.json", "b 1+c.json"):
        (tmp_path / name).write_text("{}")
    files = list_files(spark, str(tmp_path), "json")
    manifest = spark.createDataFrame([("a.json",), ("a.json",)], "file_name string")
    assert rows(unloaded_files(files, manifest), "file_name", "length") == [("b 1+c.json", 2)]
