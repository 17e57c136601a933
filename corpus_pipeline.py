"""Corpus preparation: language, near duplicates, repeated passages, contamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language, near_duplicates, packing, substrings
from tidemark.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text is no language if its best language holds less than this part of its n-grams.
KNOWN = 0.2
SIMILARITY, SHINGLE = 0.8, 5

# The five stages learn, sketch, match statistics and solve a program: no SQL gives their rows. They
# are tested against brute force instead.
ORACLE_SQL = None


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without letters, null ones, and those of no known language go.

    The languages are learned from the labels of the documents given. Where none has a label,
    nothing can be told apart and only documents without letters go.
    """
    filters = language.fit(docs)
    if not filters.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    found = language.identify(docs, filters)
    known = (F.col("lang_pred") != "und") & (F.col("known") >= KNOWN)
    return found.where(known).select("row.*").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Five-word shingles, similarity of 0.8 or more. Documents without words are in no group and stay.
    Of rows that agree in id and text one stays; rows without an id stay where their group has no
    other.
    """
    found = near_duplicates.components(docs, SIMILARITY, SHINGLE).where("kept").select("id", "tie").distinct()
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.withColumn("tie", tie).dropDuplicates(["doc_id", "tie"])
    kept = rows["doc_id"].eqNullSafe(found["id"]) & (rows["tie"] == found["tie"])
    return rows.join(found, kept, "left_semi").select(*COLUMNS)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that an earlier document has.

    A text that loses nothing is left as it is; of others the remaining words are joined by one
    space, and n_chars counts them.
    """
    # The text goes along in the row, to be kept where nothing is lost.
    found = substrings.remove_repeated(docs.withColumn("whole", F.col("text")).select(*COLUMNS, "whole"))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.whole"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))
    return found.select(
        "row.doc_id", text.alias("text"), "row.lang", "row.source", chars.alias("n_chars")
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth stand in passages of ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontamination.contamination(docs, items)
    return found.where(~F.col("contaminated")).select("row.*").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 1024 tokens, with the crc32 of their ids."""
    pieces = packing.encode_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    placed = packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", remove_passages),
    ("contamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
