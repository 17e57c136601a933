"""Language of texts by n-gram filters that answer for all languages at once.

Each language's model is the set of character n-grams that are common in it. The sets are kept in one
bit-sliced Bloom filter: a row of bits for each position, one bit for each language. The rows of an
n-gram's positions, anded, are the mask of all languages that hold it; a text's n-grams give a count
for each language, from which the hits that its false-positive rate makes expected are taken off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.encoding import text_groups
from tidemark.llm.words import mixed
from tidemark.session import stored

# N-grams of these lengths in letters; blanks at word ends count as a letter.
SIZES = (2, 3, 4)
# About so many training texts of a language, chosen by a hash of the id; with fewer, all of them.
SAMPLE_TEXTS = 3000
# An n-gram belongs to a language if its share there is this part of its greatest share anywhere,
# and at least so high.
RELATIVE_SHARE = 0.3
LEAST_SHARE = 2e-6
# The filter: positions, positions of an n-gram, and n-grams kept of a language.
POSITIONS = 1 << 20
HASHES = 3
KEPT = 60_000
# Bytes of text handled at a time.
GROUP_BYTES = 250_000


def letters_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts as code points, runs of others as one blank; owner of each.

    Each text begins and ends with a blank, so no n-gram has letters of two texts.
    """
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    # Code points that begin before each byte offset tell where a text begins in code points.
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(begins))
    lower, is_letter = _tables()
    codes = lower[codes]
    letter = is_letter[codes]
    codes = np.where(letter, codes, 32).astype(np.uint32)
    first = np.ones(len(codes), bool)
    first[1:] = owner[1:] != owner[:-1]
    after = np.zeros(len(codes), bool)
    after[1:] = letter[:-1]
    # Letters, and the first blank after a letter; then a blank before each text's first letter.
    keep = letter | (after & ~first)
    codes, owner = codes[keep], owner[keep]
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    codes = np.insert(codes, np.append(starts, len(codes)), 32)
    owner = np.append(np.insert(owner, starts, owner[starts]), -1)
    return codes, owner


_kept: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """For each code point its lower case, where that is one code point, and whether it is a letter."""
    if not _kept:
        lower, letter = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
        # Surrogates are no characters.
        for code in chain(range(0xD800), range(0xE000, 0x110000)):
            point = chr(code)
            letter[code] = point.isalpha()
            small = point.lower()
            if small != point and len(small) == 1:
                lower[code] = ord(small)
        lower[0xD800:0xE000] = 32
        _kept.extend((lower, letter))
    return _kept


def grams_of(codes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and owner of each n-gram of ``size`` that lies in one text and is not all blank."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = owner[:n] == owner[size - 1 :][:n]
    value = np.full(n, size, np.uint64)
    for k in range(size):
        value = value * np.uint64(1_114_129) + codes[k : k + n]
    return mixed(value[inside]), owner[:n][inside]


@dataclass
class Filters:
    """The bit-sliced filter, its languages, and the false-positive rate of each."""

    languages: list[str]
    rows: np.ndarray  # positions x bytes of the language mask
    false_rate: np.ndarray

    @staticmethod
    def build(grams: dict[str, np.ndarray], positions: int = POSITIONS, hashes: int = HASHES) -> Filters:
        languages = sorted(grams)
        rows = np.zeros((positions, -(-len(languages) // 8)), np.uint8)
        fill = np.zeros(len(languages))
        for bit, language in enumerate(languages):
            for at in _positions(grams[language], positions, hashes):
                rows[at, bit // 8] |= np.uint8(1 << bit % 8)
            fill[bit] = ((rows[:, bit // 8] >> (bit % 8)) & 1).mean()
        return Filters(languages, rows, fill**hashes)

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """Mask of all languages that hold each n-gram."""
        found = None
        for at in _positions(hashes, len(self.rows), HASHES):
            rows = self.rows[at]
            found = rows if found is None else found & rows
        return found

    def hits(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of each of ``n`` texts, and how many of them each language holds."""
        masks = self.masks(hashes)
        counts = np.zeros((n, len(self.languages)))
        for bit in range(len(self.languages)):
            held = (masks[:, bit // 8] >> (bit % 8)) & 1
            counts[:, bit] = np.bincount(owner, held, minlength=n)
        return np.bincount(owner, minlength=n), counts


def _positions(hashes: np.ndarray, positions: int, n: int) -> Iterator[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(n):
        yield ((hashes + step * np.uint64(k)) % np.uint64(positions)).astype(np.int64)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_texts: int = SAMPLE_TEXTS,
    kept: int = KEPT,
) -> Filters:
    """Filters of all languages named in ``docs``, from whole texts of a bounded sample.

    ``sample_texts`` bounds the texts of a language on average: they are chosen by the hash of their
    id at the rate that gives so many, so the work of fitting does not grow with the table. The
    n-grams are counted by Spark, and the ``kept`` most frequent of a language make its filter.
    """
    labelled = docs.select(
        F.xxhash64(F.col(id_col).cast("string")).alias("draw"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Filters.build({})
    spread = 1_000_000
    rate = F.create_map(
        *(x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(int(min(1, sample_texts / n) * spread))))
    )
    drawn = labelled.where(F.pmod("draw", F.lit(spread)) < rate[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            code = langs.indices.to_numpy()
            for row, data, offsets in text_groups(batch.column("text"), GROUP_BYTES):
                codes, owner = letters_of(data, offsets)
                for size in SIZES:
                    hashes, text = grams_of(codes, owner, size)
                    lang = code[row + text]
                    for k in np.unique(lang):
                        found, n = np.unique(hashes[lang == k], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([langs.dictionary[k].as_py()] * len(found)),
                                pa.array(found.view(np.int64)),
                                pa.array(np.full(len(found), size)),
                                pa.array(n),
                            ],
                            names=["lang", "gram", "size", "n"],
                        )

    counts = drawn.mapInArrow(count, "lang string, gram long, size long, n long")
    counts = stored(counts.groupBy("lang", "gram", "size").agg(F.sum("n").alias("n")), "grams")
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), ["lang", "size"]).select(
        "lang", "gram", (F.col("n") / F.col("total")).alias("share")
    )
    top = shares.groupBy("gram").agg(F.max("share").alias("top"))
    chosen = stored(
        shares.where(F.col("share") >= LEAST_SHARE)
        .join(top, "gram")
        .where(F.col("share") >= RELATIVE_SHARE * F.col("top"))
        .select("lang", "gram", "share"),
        "chosen-grams",
    )
    grams = {}
    for lang in sizes:
        best = chosen.where(F.col("lang") == lang).orderBy(F.desc("share"), "gram").limit(kept).select("gram")
        grams[lang] = best.toPandas()["gram"].to_numpy(np.int64).view(np.uint64)
    return Filters.build(grams)


def decide(filters: Filters, n_grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Language number, -1 for none, score, and the winner's share of the n-grams of each text.

    The share of its n-grams that a language holds, corrected for false positives; the score is the
    winner's part of the two best shares together, doubled and less one, times its share.
    """
    if not filters.languages:
        return np.full(len(n_grams), -1), np.zeros(len(n_grams)), np.zeros(len(n_grams))
    total = np.maximum(n_grams, 1)[:, None]
    corrected = np.clip((counts - total * filters.false_rate) / (total * (1 - filters.false_rate)), 0, 1)
    best = corrected.argmax(axis=1)
    top = corrected[np.arange(len(best)), best]
    rest = corrected.copy()
    rest[np.arange(len(best)), best] = 0
    second = rest.max(axis=1)
    margin = np.divide(top - second, top, out=np.zeros(len(top)), where=top > 0)
    return np.where(n_grams > 0, best, -1), np.where(n_grams > 0, top * margin**0.25, 0.0), np.where(n_grams > 0, top, 0.0)


def identify(docs: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` in a struct ``row``, with lang_pred, score and known.

    ``lang_pred`` is one of the filters' languages, or ``und`` with score 0 for texts that are null
    or have no letter, and for all where nothing was learned. Ties go to the first language by name.
    The score is from 0 to 1, and so is ``known``, the share of the text's n-grams that its language
    holds, which is low for what is no language. Whole texts are read; a long one is handled alone. Nothing is
    shuffled, and what is broadcast is the filter, whose size is fixed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    rows = docs.select(F.struct("*").alias("row"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, "und"], object)
        for batch in batches:
            column = batch.column("row")
            for row, data, offsets in text_groups(column.field(text_col), GROUP_BYTES):
                n = len(offsets) - 1
                codes, owner = letters_of(data, offsets)
                n_grams, counts = np.zeros(n, np.int64), np.zeros((n, len(known.languages)))
                for size in SIZES:
                    hashes, text = grams_of(codes, owner, size)
                    some, hits = known.hits(hashes, text, n) if known.languages else (0, 0)
                    n_grams += some
                    counts += hits
                best, score, share = decide(known, n_grams, counts)
                yield pa.RecordBatch.from_arrays(
                    [column.slice(row, n), pa.array(names[best], pa.string()), pa.array(score), pa.array(share)],
                    names=["row", "lang_pred", "score", "known"],
                )

    schema = T.StructType(
        [rows.schema["row"], T.StructField("lang_pred", T.StringType())]
        + [T.StructField(name, T.DoubleType()) for name in ("score", "known")]
    )
    return rows.mapInArrow(predict, schema)
