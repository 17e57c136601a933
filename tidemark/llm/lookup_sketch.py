"""Fingerprints of texts as invertible Bloom lookup sketches of their paragraphs, in SQL alone.

A paragraph is a line; a line is cut further after each sentence mark that a blank follows, or that
belongs to a script without blanks, so that a text of one line has parts as well. What is still long is
cut where its own words say so, so that equal stretches of two texts are cut alike whatever surrounds
them. Each distinct paragraph has a 64-bit digest: 40 bits of its hash
and 24 check bits made from them. A sketch has three tables of cells; a digest is xored into one cell
of each. The sketches of two versions, subtracted cell by cell, hold only the digests in which they
differ. A cell whose check bits fit holds one digest alone; taking it out of its other cells may lay
open further ones, until all cells are zero. If that fails, larger sketches are tried: first the
digests are dealt to so many sketches that each has a few, then those that still fail get more cells.

The fingerprint is the sketch of the smallest size. Nothing here runs Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

# Cells of a table in the fingerprint, as a power of two.
CELL_BITS = 3
# The same for dealt sketches, tried one after the other, and a salt for the places of their cells. A few digests
# need few cells; after the small sizes each try has other places, so it fails with 2e-5 or less.
TRIES = ((2, 0), (3, 0), (5, 0), (6, 1), (6, 2), (6, 3))
# Rounds of peeling; each takes out all digests that lie open.
ROUNDS = 12
# Digests of a version that share one of the dealt sketches, on average, at most.
SHARE = 4
# Where a line is cut into paragraphs. The marks of other scripts need no blank after them.
MARKS = "。！？｡．।॥؟۔።။។"
SENTENCE = rf"\n+|(?<=[.!?])[ \t]+|(?<=[{MARKS}])(?![{MARKS}])"
# A longer paragraph, in characters, is cut after some of its words; a longer word is many words there.
LONG_PARAGRAPH, LONG_WORD = 160, 64
# One word in so many ends a part, by its hash and that of the word before it; a part has at most so many.
PART_EVERY, PART_MOST = 8, 16

_LOW, _HIGH = 16777215, -16777216


def _parts(units: str, tag: str) -> str:
    """SQL: an array of words joined to parts that end at words chosen by their hash."""
    last = f"i{tag} = size({units}) OR pmod(xxhash64(get({units}, i{tag} - 2), {units}[i{tag} - 1]), {PART_EVERY}) = 0"
    ends = f"filter(sequence(1, size({units})), i{tag} -> {last})"
    begin = f"if(k{tag} = 0, 0, get(n{tag}, k{tag} - 1))"
    part = f"array_join(slice({units}, b{tag} + 1, least({PART_MOST}, e{tag} - b{tag})), '')"
    return (
        f"transform(array({ends}), n{tag} -> flatten(transform(n{tag}, (e{tag}, k{tag}) ->"
        f" transform(sequence({begin}, e{tag} - 1, {PART_MOST}), b{tag} -> {part}))))[0]"
    )


def _cut(paragraph: str) -> str:
    """SQL: the parts of a long paragraph. Joined they are the paragraph; blanks stay with the word before.

    The characters of a long word are joined to words in the same way, unless they are all the same.
    """
    chars = f"transform(array(split(w, '')), c -> if(size(array_distinct(c)) < 2, array(w), {_parts('c', 'c')}))[0]"
    split = f"split({paragraph}, r'(?<=[ \\t])(?=[^ \\t])')"
    words = f"flatten(transform({split}, w -> if(char_length(w) <= {LONG_WORD}, array(w), {chars})))"
    return f"transform(array({words}), u -> {_parts('u', 'u')})[0]"


def digests(text: str) -> str:
    """SQL: the distinct digests of a text's paragraphs; blank ones do not count."""
    lines = f"filter(split({text}, r'{SENTENCE}'), p -> p <> '')"
    pieces = f"flatten(transform({lines}, p -> if(char_length(p) <= {LONG_PARAGRAPH}, array(p), {_cut('p')})))"
    keys = f"transform({pieces}, p -> xxhash64(p) & {_HIGH}L)"
    return f"array_distinct(transform({keys}, k -> k | (xxhash64(k) & {_LOW}L)))"


def _signed(number: int) -> int:
    return (number & (1 << 64) - 1 ^ 1 << 63) - (1 << 63)


def _places(bits: int) -> str:
    """SQL: for each cell of all three tables which bits of a number place it there, and their value."""
    cells = []
    for cell in range(3 * 2**bits):
        shift = 44 + bits * (cell >> bits)
        mask, value = _signed((2**bits - 1) << shift), _signed((cell & 2**bits - 1) << shift)
        cells.append(f"named_struct('m', {mask}L, 'v', {value}L)")
    return f"array({', '.join(cells)})"


def _within(digests_: str, start: str, place: str, tag: str, salt: int) -> str:
    """SQL: ``start`` with all digests xored in that belong to a place."""
    number = f"xxhash64(d{tag}, {salt})" if salt else f"d{tag}"
    return f"aggregate({digests_}, {start}, (a{tag}, d{tag}) -> if(({number} & {place}.m) = {place}.v, a{tag} ^ d{tag}, a{tag}))"


def sketch(keys: str, bits: int, tag: str = "", salt: int = 0) -> str:
    """SQL: the cells of a sketch of an array of digests."""
    return f"transform({_places(bits)}, p{tag} -> {_within(keys, '0L', f'p{tag}', tag, salt)})"


def peel(cells: str, bits: int, tag: str, salt: int = 0) -> str:
    """SQL: how many digests a subtracted sketch holds, -1 if they cannot all be recovered."""
    lone = f"(v{tag} <> 0L AND (v{tag} & {_LOW}L) = (xxhash64(v{tag} & {_HIGH}L) & {_LOW}L))"
    found = f"array_distinct(filter(s{tag}.c, v{tag} -> {lone}))"
    out = f"zip_with(s{tag}.c, {_places(bits)}, (v{tag}, p{tag}) -> {_within(f'f{tag}', f'v{tag}', f'p{tag}', tag, salt)})"
    # A round that finds nothing is the last; the rest of the sequence passes the state on.
    step = (
        f"if(NOT s{tag}.go, s{tag}, transform(array({found}), f{tag} -> if(size(f{tag}) = 0,"
        f" named_struct('c', s{tag}.c, 'n', s{tag}.n, 'go', false),"
        f" named_struct('c', {out}, 'n', s{tag}.n + size(f{tag}), 'go', true)))[0])"
    )
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('c', {cells}, 'n', 0L, 'go', true), (s{tag}, r{tag}) -> {step},"
        f" s{tag} -> if(forall(s{tag}.c, v{tag} -> v{tag} = 0L), s{tag}.n, -1L))"
    )


def _tried(a: str, b: str, level: int, tag: str) -> str:
    """SQL: number of differing digests of two arrays by sketches of rising size and other salts."""
    if level == len(TRIES):  # not to be expected once in 10^13 comparisons
        return f"CAST(size(array_except({a}, {b})) + size(array_except({b}, {a})) AS BIGINT)"
    (bits, salt), own = TRIES[level], f"{tag}{level}"
    sides = sketch(a, bits, own + "x", salt), sketch(b, bits, own + "y", salt)
    cells = f"zip_with({sides[0]}, {sides[1]}, (x{own}, y{own}) -> x{own} ^ y{own})"
    again = _tried(a, b, level + 1, tag)
    return f"transform(array({peel(cells, bits, own, salt)}), n{own} -> if(n{own} >= 0L, n{own}, {again}))[0]"


def _dealt(keys: str, tag: str) -> str:
    """SQL: the digests in ``shares`` lists by 20 of their bits, in two steps of at most 32 and the rest."""
    coarse = f"(shiftrightunsigned(d{tag}, 24) % least(shares, 32L)) = g{tag}"
    fine = f"(shiftrightunsigned(d{tag}, 29) % greatest(shares div 32, 1L)) = h{tag}"
    return (
        f"flatten(transform(sequence(0L, least(shares, 32L) - 1), g{tag} ->"
        f" transform(array(filter({keys}, d{tag} -> {coarse})), k{tag} ->"
        f" transform(sequence(0L, greatest(shares div 32, 1L) - 1), h{tag} -> filter(k{tag}, d{tag} -> {fine})))[0]))"
    )


def differing(frame: DataFrame, a: str, b: str, base_a: str, base_b: str, out: str) -> DataFrame:
    """``frame`` with ``out``: how many digests arrays ``a`` and ``b`` do not share.

    ``base_a`` and ``base_b`` are their smallest sketches, tried first.
    """
    first = peel(f"zip_with({base_a}, {base_b}, (x, y) -> x ^ y)", CELL_BITS, "z")
    wanted = f"greatest(size({a}), size({b})) / {SHARE}"
    shares = f"CAST(power(2, least(20, greatest(0, ceil(log2(greatest({wanted}, 1)))))) AS BIGINT)"
    parts = f"zip_with({_dealt(a, 'p')}, {_dealt(b, 'q')}, (l, m) -> {_tried('l', 'm', 0, 't')})"
    dealt = f"aggregate({parts}, 0L, (t, n) -> t + n)"
    kept = frame.columns
    frame = frame.select(*kept, F.expr(first).alias("by_base"), F.expr(shares).alias("shares"))
    return frame.select(*kept, F.expr(f"if(by_base >= 0L, by_base, {dealt})").alias(out))


def likeness(a: str, b: str, difference: str) -> Column:
    """Shared part of two sets of digests, 1 where both are empty."""
    return F.expr(
        f"if(size({a}) + size({b}) = 0, 1D,"
        f" (size({a}) + size({b}) - {difference}) / CAST(size({a}) + size({b}) + {difference} AS DOUBLE))"
    )


def fingerprint(keys: str, base: str) -> Column:
    """Text form of a smallest sketch: number of digests, then its cells in hexadecimal."""
    cells = F.expr(f"array_join(transform({base}, v -> lpad(lower(hex(v)), 16, '0')), '')")
    return F.concat_ws(":", F.size(keys).cast("string"), cells)


def successors(docs: DataFrame) -> DataFrame:
    """(id, next_id, half) of each distinct id: the id that follows, the first after the last, and
    half the characters of the longest text with this id. Ids alone are sorted, in ranges."""
    ids = docs.where("id IS NOT NULL").groupBy("id").agg(F.max(F.length("text")).alias("most"))
    ranged = stored(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "ids")
    parts = ranged.groupBy("part").agg(F.min("id").alias("first"))
    # One row for each range: this window is small however many ids there are.
    follow = Window.orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    after = parts.select("part", F.min("first").over(follow).alias("after"))
    inside = Window.partitionBy("part").orderBy("id")
    least = ranged.agg(F.min("id").alias("least"))
    chain = (
        ranged.select("id", "part", "most", F.lead("id").over(inside).alias("follower"))
        .join(after, "part")
        .join(F.broadcast(least))
        .select("id", F.coalesce("follower", "after", "least").alias("next_id"), F.floor(F.col("most") / 2).alias("half"))
    )
    return stored(chain, "successors")


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row of ``docs`` (id, text) beside its edited text and the whole of what follows it.

    (id, text, n_chars, edited, own_keys, next_keys): the keys are the digests of the text and of what
    follows it, made once for each row and carried to its neighbour. ``edited`` is the text with its last half, rounded down,
    replaced by as many first characters of the next document in order of id, or all it has; the
    first follows the last. Of several rows with one id, the one with the least text hash stands for
    it as a follower; a row without an id is followed by nothing. Null texts are empty.
    """
    whole = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chain = successors(whole)
    whole = whole.withColumn("own_keys", F.expr(digests("text")))
    # Without null ids both joins below deal the texts alike, and one shuffle of them serves both.
    rows = whole.where("id IS NOT NULL")
    counts = rows.groupBy("id").agg(F.count("*").alias("n"))
    followers = rows
    if not counts.where("n > 1").isEmpty():
        first = F.min_by(F.struct("text", "own_keys"), F.xxhash64("text")).alias("first")
        followers = rows.groupBy("id").agg(first).select("id", "first.*")
    following = followers.join(chain.select(F.col("id").alias("of"), "next_id", "half"), F.col("id") == F.col("next_id")).select(
        "of", F.expr("substring(text, 1, CAST(half AS INT))").alias("head"), F.col("own_keys").alias("next_keys")
    )
    followed = rows.join(following, F.col("id") == F.col("of"), "left").select(
        "id", "text", "own_keys", "head", "next_keys"
    )
    last = whole.where("id IS NULL").select(
        "id", "text", "own_keys", F.lit("").alias("head"), F.expr(digests("''")).alias("next_keys")
    )
    joined = followed.unionByName(last).select(
        "id", "text", "own_keys", F.length("text").alias("n_chars"), F.coalesce("head", F.lit("")).alias("head"),
        F.coalesce("next_keys", F.array().cast("array<bigint>")).alias("next_keys"),
    )
    edited = "concat(substring(text, 1, n_chars - n_chars div 2), substring(head, 1, CAST(n_chars div 2 AS INT)))"
    edited = edited.replace("n_chars - n_chars div 2", "CAST(n_chars - n_chars div 2 AS INT)")
    return joined.select("id", "text", "n_chars", F.expr(edited).alias("edited"), "own_keys", "next_keys")


def compare_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each row of ``docs`` and of its edited text, and their likeness.

    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). Likeness is
    the part of all distinct paragraphs of both texts that both have. Equal texts have equal
    fingerprints; empty texts have no paragraphs and are alike; an empty table gives an empty result.
    """
    base = CELL_BITS
    keyed = versions(docs, id_col, text_col).select(
        "id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "own_keys",
        F.expr(digests("edited")).alias("edited_keys"),
        "next_keys",
    )
    keys = ("own", "edited", "next")
    sketched = keyed.select("*", *(F.expr(sketch(f"{k}_keys", base)).alias(f"{k}_base") for k in keys))
    for other in ("edited", "next"):
        sketched = differing(sketched, "own_keys", f"{other}_keys", "own_base", f"{other}_base", f"off_{other}")
    return sketched.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        fingerprint("own_keys", "own_base").alias("fingerprint"),
        fingerprint("edited_keys", "edited_base").alias("edited_fingerprint"),
        likeness("own_keys", "edited_keys", "off_edited").alias("near_edited"),
        likeness("own_keys", "next_keys", "off_next").alias("near_next"),
    )
