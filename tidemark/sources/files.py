"""CSV, JSON and binary files as DataFrames, with the file name as lineage."""

from __future__ import annotations

import logging
import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import decoded_file_name, na_to_null
from tidemark.session import stored

log = logging.getLogger(__name__)

LINEAGE = "source_filename"
# Where Spark puts the text of a record that does not fit.
CORRUPT = "_corrupt_record"

# Plain decimal notation. A bare cast would also take a trailing "d" or "f".
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def any_case(suffix: str) -> str:
    """A file glob for ``suffix`` in any mix of cases: ``csv`` gives ``*.[cC][sS][vV]``."""
    letters = [f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix]
    return "*." + "".join(letters)


def directory_glob(directory: str, suffix: str) -> str:
    """The files lying directly in ``directory``; sub-directories are not entered."""
    return f"{directory.rstrip('/')}/{any_case(suffix)}"


def or_none(load) -> DataFrame | None:
    """``load()``, or None where no file matches."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def lineage_column() -> Column:
    return decoded_file_name(F.col("_metadata.file_name")).alias(LINEAGE)


def without_rejects(rows: DataFrame, bad: Column, rejects: str | None) -> DataFrame:
    """``rows`` with a ``_corrupt_record`` and a lineage column, without the records that are bad.

    Without a ``rejects`` folder the first bad record raises, with its file and text, in the one
    pass that reads the rows. With one, the rows are parsed once into a copy; bad records are added
    to the folder as ``source_filename, record`` and counted in the log, and the good rows go on.
    """
    if rejects is None:
        told = F.concat(F.lit("bad record in "), F.col(LINEAGE), F.lit(": "), F.col(CORRUPT))
        return rows.where(F.when(bad, F.raise_error(told).cast("boolean")).otherwise(F.lit(True))).drop(CORRUPT)
    copy = stored(rows.withColumn("_bad", bad), "parsed")
    refused = copy.where("_bad").select(LINEAGE, F.col(CORRUPT).alias("record"))
    n = refused.count()
    if n:
        log.warning("%s bad records, kept in %s", n, rejects)
        refused.write.mode("append").parquet(rejects)
    return copy.where("NOT _bad").drop(CORRUPT, "_bad")


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """``source_filename, record`` of all records refused so far."""
    schema = f"{LINEAGE} string, record string"
    rows = or_none(lambda: spark.read.schema(schema).parquet(rejects))
    return spark.createDataFrame([], schema) if rows is None else rows


def _csv_reader(spark: SparkSession, separator: str, multi_line: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("sep", separator)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def _cells(record: Column, separator: str) -> Column:
    """Number of cells of a CSV record. A quote opens a cell only where the cell begins.

    Quoted cells are cut out, each in one pass that takes no stack, and separators counted in the rest.
    """
    sep = re.escape(separator)
    rest = F.regexp_replace(record, f'(^|{sep})"(?:[^"]++|"")*+"', "$1")
    return 1 + F.floor((F.length(rest) - F.length(F.replace(rest, F.lit(separator), F.lit("")))) / len(separator))


def _csv_rows(
    spark: SparkSession, path, separator: str, multi_line: bool, rejects: str | None, lineage: bool
) -> DataFrame:
    """Text cells of CSV files with one header, missing-value tokens as NULL.

    A short line is filled up with NULL; a line with more cells than the header is a bad record.
    """
    reader = _csv_reader(spark, separator, multi_line)
    names = reader.csv(path).columns
    schema = StructType([StructField(n, StringType()) for n in [*names, CORRUPT]])
    rows = reader.schema(schema).csv(path)
    bad = F.col(CORRUPT).isNotNull() & (_cells(F.col(CORRUPT), separator) > len(names))
    good = without_rejects(rows.select("*", lineage_column()), bad, rejects)
    return na_to_null(good if lineage else good.drop(LINEAGE))


def _header_names(cells: list[str | None]) -> list[str]:
    """Column names of a header's cells, as Spark's reader gives them: empty ones by their place, and
    ones that occur twice, in any case, with their place behind."""
    lower = [(c or "").lower() for c in cells]
    return [
        f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c for i, c in enumerate(cells)
    ]


def _csv_mixed(
    spark: SparkSession,
    glob: str,
    headers: DataFrame,
    separator: str,
    multi_line: bool,
    rejects: str | None,
) -> DataFrame:
    """Text cells of CSV files with any number of headers, in one scan, aligned by column name.

    Cells are read by place, as many as the widest header has. A row meets the header of its file in a
    join, and each column takes the cell at the place that the header gives it.
    """
    distinct = stored(headers.select("header").distinct().withColumn("n", _cells(F.col("header"), separator)), "header-lines")
    widest = distinct.agg(F.max("n")).first()[0]
    places = [f"_p{i}" for i in range(widest)]
    generic = StructType([StructField(name, StringType()) for name in places])
    options = {"sep": separator, "quote": '"', "escape": '"'}
    parsed = F.from_csv("header", F.lit(generic.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")), options)
    lists = distinct.select("header", "n", F.array(*[parsed[p] for p in places]).alias("cells")).orderBy("header").collect()
    names_of = {row["header"]: _header_names(row["cells"][: row["n"]]) for row in lists}
    # Spark takes names that differ by case only for one.
    columns: dict[str, str] = {}
    for names in names_of.values():
        for name in names:
            columns.setdefault(name.lower(), name)
    index = [
        (header, len(names), [lower.index(c) if c in lower else None for c in columns])
        for header, names in names_of.items()
        for lower in [[n.lower() for n in names]]
    ]
    by_header = spark.createDataFrame(index, "header string, width int, places array<int>")
    by_file = headers.join(by_header, "header").select("file", "width", "places")
    rows = _csv_reader(spark, separator, multi_line).schema(generic.add(CORRUPT, StringType())).csv(glob)
    rows = rows.select(F.array(*places).alias("cells"), CORRUPT, lineage_column(), F.col("_metadata.file_path").alias("file"))
    aligned = rows.join(by_file, "file")
    bad = F.col(CORRUPT).isNotNull() & (_cells(F.col(CORRUPT), separator) > F.col("width"))
    taken = [F.get("cells", F.col("places")[i]).alias(name) for i, name in enumerate(columns.values())]
    marked = aligned.select(*taken, CORRUPT, LINEAGE, F.coalesce(bad, F.lit(False)).alias("_surplus"))
    return na_to_null(without_rejects(marked, F.col("_surplus"), rejects).drop("_surplus"))


def read_text_csv(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    *,
    multi_line: bool = True,
    rejects: str | None = None,
) -> DataFrame:
    """Every column as text, kept as written; missing-value tokens are NULL.

    ``multi_line`` allows line breaks inside quoted cells, at the price of one task per file. Data
    known to have none should pass False, and then a large file is split. A line with more cells
    than the header raises, or goes to the ``rejects`` folder.
    """
    return _csv_rows(spark, path, separator, multi_line, rejects, lineage=False)


def read_typed_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    separator: str = ";",
    *,
    multi_line: bool = True,
    rejects: str | None = None,
) -> DataFrame:
    """A CSV with a declared schema, or with types found in the data when none is given.

    Cells are read as text first, so a missing-value token is NULL in a typed column too and a
    cell that does not fit its declared type raises.
    """
    text = read_text_csv(spark, path, separator, multi_line=multi_line, rejects=rejects)
    return infer_types(text) if schema is None else _typed(text, schema)


def _typed(text: DataFrame, schema: StructType | str) -> DataFrame:
    """Text cells as the declared types, then the lineage where there is one; absent columns are
    NULL."""
    wanted = text.sparkSession.createDataFrame([], schema).schema
    cells = [
        (F.col(f"`{f.name}`") if f.name in text.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in wanted.fields
    ]
    return text.select(*cells, *[LINEAGE for c in text.columns if c == LINEAGE])


def infer_types(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text columns as BIGINT, DOUBLE or BOOLEAN where every value allows it.

    One aggregation decides for all columns. A column without any value stays text.
    """
    names = [f.name for f in df.schema.fields if f.name not in keep]
    if not names:
        return df
    votes: list[Column] = []
    for i, name in enumerate(names):
        value = F.col(f"`{name}`")
        number = value.rlike(_NUMBER)
        votes += [
            F.count(value).alias(f"n_{i}"),
            F.count(F.when(number & value.try_cast("bigint").isNotNull(), 1)).alias(f"int_{i}"),
            F.count(F.when(number, 1)).alias(f"num_{i}"),
            F.count(F.when(value.isin("True", "False", "true", "false", "TRUE", "FALSE"), 1)).alias(
                f"bool_{i}"
            ),
            # BIGINT takes "1.5" by cutting it; only whole notation may become BIGINT.
            F.count(F.when(value.rlike(r"^\s*[+-]?\d+\s*$"), 1)).alias(f"whole_{i}"),
        ]
    row = df.agg(*votes).first()
    chosen = {}
    for i, name in enumerate(names):
        n = row[f"n_{i}"]
        if n and row[f"whole_{i}"] == n and row[f"int_{i}"] == n:
            chosen[name] = "bigint"
        elif n and row[f"num_{i}"] == n:
            chosen[name] = "double"
        elif n and row[f"bool_{i}"] == n:
            chosen[name] = "boolean"
    return df.select(
        *[
            F.trim(F.col(f"`{f.name}`")).cast(chosen[f.name]).alias(f.name)
            if f.name in chosen
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _headers(spark: SparkSession, glob: str) -> DataFrame | None:
    """``file, header`` of each file: its first line that is not blank.

    Lines of a split come in order within a task, so the least row number among a file's first
    split marks its header. Only one line per file leaves a task.
    """
    lines = or_none(lambda: spark.read.text(glob))
    if lines is None:
        return None
    numbered = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    first_split = numbered.where((F.col("start") == 0) & (F.trim("value") != ""))
    return first_split.groupBy("file").agg(F.min_by("value", "row").alias("header"))


def read_csv_dir(
    spark: SparkSession,
    directory: str,
    separator: str = ";",
    *,
    schema: StructType | str | None = None,
    one_header: bool = False,
    infer: bool = True,
    multi_line: bool = True,
    rejects: str | None = None,
) -> DataFrame | None:
    """All ``*.csv`` files of a directory, in any case, unioned by column name.

    All are read in one scan by place, and each row's cells go to the columns that its own file's
    header names; ``one_header`` says that all files have the same one, and then no pass looks for
    headers. ``schema`` declares the types, so that none looks for those either. Returns None when
    there is no file, which the caller takes as "keep what is loaded".
    """
    glob = directory_glob(directory, "csv")
    headers, n = None, 0
    if not one_header:
        headers = _headers(spark, glob)
        if headers is not None:
            headers = stored(headers, "headers")
            n = headers.agg(F.count_distinct("header")).first()[0]
    elif or_none(lambda: spark.read.text(glob)) is not None:
        n = 1
    if not n:
        log.warning("no CSV files in %s", directory)
        return None
    if n == 1:
        text = _csv_rows(spark, glob, separator, multi_line, rejects, lineage=True)
    else:
        text = _csv_mixed(spark, glob, headers, separator, multi_line, rejects)
    if schema is not None:
        return _typed(text, schema)
    return infer_types(text, keep=(LINEAGE,)) if infer else text


def read_json_dir(
    spark: SparkSession,
    directory: str,
    schema: StructType | str | None = None,
    *,
    multi_line: bool = True,
    rejects: str | None = None,
) -> DataFrame | None:
    """All ``*.json`` files of a directory; fields a file lacks are NULL.

    ``multi_line`` reads each file as one document or one array of records; without it each line
    is a record and files can be split. A record that is no JSON raises, or goes to the ``rejects``
    folder, and the good ones are loaded.
    """

    def load() -> DataFrame:
        reader = spark.read.option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT)
        if schema is not None:
            fields = spark.createDataFrame([], schema).schema
            reader = reader.schema(StructType([*fields.fields]).add(CORRUPT, StringType()))
        return reader.json(directory_glob(directory, "json"))

    rows = or_none(load)
    if rows is None:
        log.warning("no JSON files in %s", directory)
        return None
    rows = rows.select("*", lineage_column())
    # An inferred schema has the column only where a record was bad.
    if CORRUPT not in rows.columns:
        return rows
    return without_rejects(rows, F.col(CORRUPT).isNotNull(), rejects)


def read_documents(
    spark: SparkSession, directory: str, pattern: str = "*.json", *, whole_file: bool = True
) -> DataFrame | None:
    """Raw documents as ``payload VARIANT, source_filename, raw``.

    A text that is not JSON has a NULL payload and keeps its text in ``raw``; it neither stops the
    load nor vanishes. Spark's parser ends with the document, so text behind it is not an error.
    ``whole_file=False`` takes one document per line.
    """
    path = f"{directory.rstrip('/')}/{pattern}"
    lines = or_none(lambda: spark.read.text(path, wholetext=whole_file))
    if lines is None:
        log.warning("no files %s in %s", pattern, directory)
        return None
    payload = F.try_parse_json("value")
    return lines.select(
        payload.alias("payload"),
        lineage_column(),
        F.when(payload.isNull(), F.col("value")).alias("raw"),
    )


def read_binary_documents(
    spark: SparkSession, directory: str, suffix: str = ".json"
) -> DataFrame | None:
    """Whole files as ``file_name, content`` rows; the suffix must match in case."""
    glob = f"{directory.rstrip('/')}/*{suffix}"
    files = or_none(lambda: spark.read.format("binaryFile").load(glob))
    if files is None:
        return None
    return files.select(
        decoded_file_name(F.col("_metadata.file_name")).alias("file_name"), "content"
    )


def list_files(spark: SparkSession, directory: str, suffix: str) -> DataFrame | None:
    """``file_name, length, modified`` of the files in a directory; no content is read."""
    glob = directory_glob(directory, suffix)
    files = or_none(lambda: spark.read.format("binaryFile").load(glob))
    if files is None:
        return None
    return files.select(
        decoded_file_name(F.col("_metadata.file_name")).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def read_latest_partition(
    spark: SparkSession,
    base: str,
    partition: str,
    schema: StructType | str,
    *,
    file_format: str = "parquet",
    multi_line: bool = True,
    rejects: str | None = None,
) -> DataFrame:
    """The rows of the partition directory with the greatest name, compared as text.

    The greatest name comes from the directory listing that Spark makes for a partitioned table, not
    from the rows, so no other partition's file is opened. No partition at all gives no rows and a
    warning. ``file_format`` is ``parquet`` or ``json``; a JSON record that is none raises with its file, or goes
    to the ``rejects`` folder, and ``multi_line`` reads each file as one document or array of records.
    """
    fields = spark.createDataFrame([], schema).schema
    columns = StructType([f for f in fields.fields if f.name != partition])
    columns = columns.add(partition, "string")
    names = _partition_names(spark, base, partition)
    reader = spark.read
    if file_format == "json":
        reader = reader.option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT)
        wanted = StructType([*columns.fields]).add(CORRUPT, StringType())
    elif file_format == "parquet":
        wanted = columns
    else:
        raise ValueError(f"unknown format {file_format!r}")
    rows = or_none(lambda: reader.schema(wanted).format(file_format).load(base)) if names else None
    if rows is None:
        log.warning("no %s directories under %s", partition, base)
        return spark.createDataFrame([], columns)
    latest = rows.where(F.col(partition) == max(names))
    if file_format == "json":
        latest = without_rejects(latest.select("*", lineage_column()), F.col(CORRUPT).isNotNull(), rejects)
    return latest.select(*[f"`{f.name}`" for f in columns.fields])


def _partition_names(spark: SparkSession, base: str, partition: str) -> list[str]:
    """Values of the directories ``partition=...`` right below ``base``."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    pattern = path_of(f"{base.rstrip('/')}/{partition}=*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in fs.globStatus(pattern) or [] if s.isDirectory()]
    return [unquote(name.partition("=")[2]) for name in found]
