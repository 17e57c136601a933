"""Rows from stored web pages with JVM regular expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, functions as F

# All repetitions here are possessive or of one character class: they take one step a character, on
# no stack, whatever the page holds.

# Comments, scripts and styles are not page content. One that is not closed goes on to the end.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*+>|\z)|<style\b.*?(?:</style\s*+>|\z)"
# Attributes up to the first href, and the ones behind it; a quoted value is passed over as a whole. A
# new tag ends them.
_BEFORE = r"""(?:[^<>"'\s]++|(?!\shref\s*+=)\s|"[^"]*+"|'[^']*+')*+"""
_BEHIND = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
# href with a double-quoted, single-quoted or bare value: groups 1 to 3. Group 4 is the content; it
# ends where the anchor is closed or another begins.
ANCHOR = (
    rf"""(?i)<a(?=\s){_BEFORE}\shref\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
    rf"""{_BEHIND}>((?:[^<]++|<(?!/?a[\s>]))*+)"""
)
TAG = r"<[^<>]*+>"
TITLE = r"(?is)<title(?:\s[^<>]*+)?+>(.*?)(?:</title\s*+>|\z)"
SPACE = " \t\n\x0b\f\r"
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
# The names HTML shares with XML, and those of the Latin-1 characters.
NAMES = {"lt": "<", "gt": ">", "quot": '"', "amp": "&", "apos": "'"} | {
    name: chr(code) for name, code in name2codepoint.items() if 160 <= code <= 255
}


def _referred(reference: Column) -> Column:
    """The character of one reference; an unknown one stays as it is."""
    inner = F.regexp_extract(reference, REFERENCE, 1)
    hexadecimal = F.when(inner.rlike("^#[xX]"), F.substring(inner, 3, 10)).when(
        inner.startswith("#"), F.hex(F.substring(inner, 2, 10).try_cast("bigint"))
    )
    code = F.conv(hexadecimal, 16, 10).try_cast("bigint")
    known = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    # Surrogates and numbers beyond Unicode are no characters.
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    character = F.decode(F.unhex(F.lpad(hexadecimal, 8, "0")), "UTF-32")
    return F.coalesce(F.when(valid, character), F.try_element_at(known, inner), reference)


def unescape(text: Column) -> Column:
    """``text`` with its character references resolved, each once."""
    parts = F.split(text, REFERENCE)
    found = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), _referred)
    joined = F.zip_with(parts, found, lambda p, c: F.concat(p, F.coalesce(c, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(joined, "")).otherwise(text)


def stripped(text: Column) -> Column:
    """Without white space, line breaks included, at both ends."""
    return F.trim(text, F.lit(SPACE))


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per link: its position on the page, target and visible text.

    The page is searched once for whole anchors; target and text come from the short matches. The time
    grows with the length of the page, not faster, and a tag may be of any length.
    """
    visible = F.regexp_replace(F.col(html), HIDDEN, "")
    rest = [c for c in pages.columns if c != html]
    anchors = F.regexp_extract_all(visible, F.lit(ANCHOR), F.lit(0))
    rows = pages.select(*rest, F.posexplode(anchors).alias("position", "anchor"))
    label = stripped(F.regexp_replace(F.regexp_extract("anchor", ANCHOR, 4), TAG, ""))
    # Of the three ways to write the value one matches; the others are empty.
    href = F.concat(*[F.regexp_extract("anchor", ANCHOR, group) for group in (1, 2, 3)])
    return rows.select(
        *rest,
        "position",
        unescape(href).alias("href"),
        unescape(label).alias("label"),
    )


def page_title(html: Column | str) -> Column:
    """The text of the first title element, empty where there is none; comments do not count."""
    visible = F.regexp_replace(html, HIDDEN, "")
    return unescape(stripped(F.regexp_extract(visible, TITLE, 1)))
