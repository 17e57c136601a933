"""Text expressions. Everything here is a Column built from JVM functions."""

from __future__ import annotations

import string
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

# The cell texts a CSV reader with default missing-value rules turns into NULL.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def na_to_null(df: DataFrame) -> DataFrame:
    """Turn missing-value tokens into NULL in every string column."""
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(*NA_TOKENS), F.col(f"`{f.name}`")).alias(f.name)
            if f.dataType.simpleString() == "string"
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def decoded_file_name(file_name: Column) -> Column:
    """Undo the percent-encoding Spark puts on ``_metadata.file_name``.

    ``url_decode`` reads ``+`` as a space, so a literal plus is protected first.
    """
    return F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))


def template_fields(template: str) -> list[str]:
    """Column names used by ``template``, in order of appearance."""
    return [name for _, name, _, _ in string.Formatter().parse(template) if name]


def fill_template(template: str) -> Column:
    """``"a/{id}/{season}"`` as a concatenation of literals and columns.

    The template is read once, on the driver; a NULL field gives a NULL result.
    """
    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(F.col(name).cast("string"))
    return F.concat(*parts) if parts else F.lit("")


def _accent_pairs() -> tuple[str, str]:
    """Accented letters of the Latin blocks U+00C0..U+024F and their base letter."""
    accented, plain = [], []
    for code in range(0x00C0, 0x0250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_pairs()


def normalise_text(text: Column) -> Column:
    """Accent- and case-insensitive form: base letters, lower case, single spaces."""
    bare = F.translate(F.regexp_replace(text, r"[̀-ͯ]", ""), _ACCENTED, _PLAIN)
    return F.trim(F.regexp_replace(F.lower(bare), r"[ \t\r\n]+", " "))


def deletion_variants(text: Column, edits: int = 1) -> Column:
    """All texts reachable by deleting at most ``edits`` characters.

    Two texts within ``edits`` insertions, deletions and substitutions of each other
    share at least one variant, which turns a distance join into an equi-join.
    """
    variants = F.array(text)
    for _ in range(edits):
        shorter = F.flatten(
            F.transform(
                variants,
                lambda v: F.transform(
                    # An empty text has nothing to delete.
                    F.when(F.length(v) > 0, F.sequence(F.lit(1), F.length(v))).otherwise(
                        F.array().cast("array<int>")
                    ),
                    lambda i: F.concat(
                        F.substring(v, F.lit(1), i - 1),
                        F.substring(v, i + 1, F.length(v)),
                    ),
                ),
            )
        )
        variants = F.array_distinct(F.concat(variants, shorter))
    return variants
