"""Near duplicates by similarity sketches, banding and verification on full sets.

A text's set is its distinct word shingles. Its sketch has a fixed number of coordinates, filled in
rounds: in each round every element is thrown into one bin by a hash of its own and leaves its value
there if it is the least; values of a later round are greater than all of an earlier one. After as
many rounds as there are coordinates, each further round aims at one coordinate only, so twice as many
rounds fill all of them. Coordinates of two sketches agree with the probability of the sets' overlap,
with concentration as for independent ones, and a large set needs about one round.

Equal sets are one class. Classes that agree in a band of coordinates share a bucket. Links are found
in two steps, and only links between components matter:

1. Each bucket has a hub: the member whose own buckets are the fullest, which in a family of copies is
   near the text that the others were made from. Members are compared with their hub, by four bits of
   each coordinate, which sets far apart seldom pass, then on full sets. Buckets that still hold
   several components get another hub from the rest, ``HUBS`` at most, while hubs find links.
2. What remains of a bucket is joined by differences from its first hub. Of a member x the hub lacks a
   set A and the hub has a set D more; the symmetric difference of x and y is |A|+|D| of both less twice
   what their A and D have in common. So two members that are alike, of which one is not alike to the
   hub, must share an element of A, or else of D, and of both together a number that their sizes
   give. Elements that could make no such pair are dropped, the others of each A and D ordered by how
   many members of the hub have them, the rarest first. Two members meet on an element only if as many
   elements as they must share can follow it in both; so the first that they share is always one
   of these, and those that much of a family has come last and make no pairs by themselves, however
   far from the hub its members are. The pairs are verified on full sets.

So no pair of a bucket that could add a link is left out, and yet a family of copies costs a few
comparisons for each member: its members seldom differ from the hub in the same places.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, comb, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W
from tidemark.llm.encoding import text_bytes
from tidemark.session import stored

# Coordinates that four bits are kept of, at most.
WIDTH = 128
# How seldom a pair at the threshold may share no band.
MISSED = 5e-7
# Hubs of a bucket.
HUBS = 3
# 64-bit numbers that hold four bits of each coordinate.
PACKED = [f"bits_{k}" for k in range(8)]
# How seldom the bits may refuse a pair that is alike.
REFUSED = 1e-7
# Of the narrow tables that links and components are found in.
ROWS_PER_FILE = 200_000
SHINGLE_BYTES = 1_000_000
# For bounds in floating point.
SLACK = 1e-6


def shingle_sets(w: W.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts of a group, and the text of each; sorted by both."""
    n = np.diff(w.bounds)
    starts = w.windows(size)
    ends = starts + size
    short = np.flatnonzero((n > 0) & (n < size))
    starts = np.concatenate([starts, w.bounds[short]])
    ends = np.concatenate([ends, w.bounds[short + 1]])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = W.run_hashes(w.hashes, starts, ends)
    text = np.searchsorted(w.bounds, starts, "right") - 1
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], text[new]


def sketches(hashes: np.ndarray, text: np.ndarray, n: int, width: int) -> np.ndarray:
    """Sketch (``width`` coordinates) of each of ``n`` sets; rows of empty sets are left unfilled."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    filled = np.full((n, width), empty, np.uint64)
    flat = filled.ravel()
    for turn in range(2 * width):
        seed = W.mixed(np.array([turn + 1], np.uint64))[0]
        value = W.mixed(hashes ^ seed)
        place = value % np.uint64(width) if turn < width else np.uint64(turn - width)
        # The round stands above the hash, so that an earlier round's value always wins.
        value = (np.uint64(turn) << np.uint64(48)) | (value >> np.uint64(16))
        np.minimum.at(flat, text * width + place.astype(np.int64), value)
        open_rows = (filled == empty).any(axis=1)
        still = open_rows[text]
        if not still.any():
            break
        hashes, text = hashes[still], text[still]
    return filled


def _band_keys(filled: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(filled), bands), np.uint64)
    for r in range(rows):
        keys = W.mixed(keys ^ filled[:, r : bands * rows : rows]) + np.uint64(r)
    return W.mixed(keys ^ W.mixed(np.arange(1, bands + 1).astype(np.uint64)))


def banding(similarity: float) -> tuple[int, int]:
    """Bands and coordinates of a band: as many coordinates as let a pair at the threshold share no band
    with MISSED at most, in WIDTH coordinates (25 of 5 at 0.85, 28 of 4 at 0.8). Below a similarity of
    0.12 even bands of one coordinate are too few."""
    for rows in range(16, 0, -1):
        bands = ceil(log(MISSED) / log1p(-(similarity**rows))) if similarity < 1 else 1
        if bands * rows <= WIDTH:
            return bands, rows
    raise ValueError(f"a similarity of {similarity} needs more than {WIDTH} coordinates")


def most_differing(similarity: float, width: int) -> int:
    """Differing coordinates, of ``width``, that a pair of this similarity exceeds with REFUSED at
    most. Coordinates that differ have equal bits by chance one time in sixteen."""
    p = (1 - similarity) * 15 / 16
    tail, k = 0.0, width
    while k >= 0:
        tail += comb(width, k) * p**k * (1 - p) ** (width - k)
        if tail > REFUSED:
            return k
        k -= 1
    return 0


def _bits(filled: np.ndarray) -> list[np.ndarray]:
    """The lowest four bits of each coordinate, of 128 at most, as eight 64-bit numbers."""
    bits = np.zeros((len(filled), WIDTH), np.uint8)
    bits[:, : filled.shape[1]] = filled & np.uint64(15)
    words = np.ascontiguousarray(bits[:, ::2] | (bits[:, 1::2] << 4)).view("<i8")
    return [words[:, k].copy() for k in range(8)]


def _differing() -> Column:
    """Coordinates in which a member's bits and its leader's differ."""
    counts = []
    for name in PACKED:
        x = F.col(name).bitwiseXOR(F.col(f"l_{name}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        # The lowest bit of each four is now set where any of them was.
        counts.append(F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111))))
    return reduce(lambda a, b: a + b, counts)


def _sketched(keyed: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(id, tie, set_a, set_b, n_shingles, bits, bands) of each row; set_a and set_b name
    its set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in W.groups(batch.column("text"), SHINGLE_BYTES):
                n = len(offsets) - 1
                w = W.words_of(data, offsets, W.LOWER, W.NOT_BLANK)
                hashes, text = shingle_sets(w, shingle)
                sizes = np.bincount(text, minlength=n)
                names = []
                for salt in (0x51ED270B, 0xB492B66F):
                    sums = np.zeros(n, np.uint64)
                    np.add.at(sums, text, W.mixed(hashes ^ np.uint64(salt)))
                    names.append(sums.view(np.int64))
                filled = sketches(hashes, text, n, bands * rows)
                keys = _band_keys(filled, bands, rows)
                keys = keys[sizes > 0].view(np.int64).ravel()
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(row, n),
                        batch.column("tie").slice(row, n),
                        pa.array(names[0]),
                        pa.array(names[1]),
                        pa.array(sizes),
                        *map(pa.array, _bits(filled)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys)),
                    ],
                    names=["id", "tie", "set_a", "set_b", "n_shingles", *PACKED, "bands"],
                )

    schema = T.StructType(
        [keyed.schema["id"]]
        + [T.StructField(c, T.LongType()) for c in ("tie", "set_a", "set_b", "n_shingles", *PACKED)]
        + [T.StructField("bands", T.ArrayType(T.LongType()))]
    )
    return keyed.mapInArrow(sketch, schema)


def _both_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` of classes a and b with their texts."""
    return pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )


def _two_sets(part: pa.RecordBatch, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of both texts of each row, ascending: hash, row, whether only this text has it, and
    whether it is of text b."""
    sets = []
    for name in ("text_a", "text_b"):
        w = W.words_of(*text_bytes(part.column(name)), W.LOWER, W.NOT_BLANK)
        sets.append(shingle_sets(w, shingle))
    hashes = np.concatenate([s[0] for s in sets])
    row = np.concatenate([s[1] for s in sets])
    side = np.repeat([False, True], [len(s[0]) for s in sets])
    order = np.lexsort((hashes, row))
    hashes, row, side = hashes[order], row[order], side[order]
    twin = np.zeros(len(hashes) + 1, bool)
    twin[1:-1] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    return hashes, row, ~(twin[1:] | twin[:-1]), side


def _overlaps(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(a, b, common, total) of pairs of classes: sizes of intersection and union of the full sets."""

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                _, row, alone, _ = _two_sets(part, shingle)
                single = np.bincount(row[alone], minlength=part.num_rows)
                common = (np.bincount(row, minlength=part.num_rows) - single) // 2
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(common), pa.array(common + single)],
                    names=["a", "b", "common", "total"],
                )

    both = _both_texts(pairs, texts).select("a", "b", "text_a", "text_b")
    return both.mapInArrow(overlap, "a long, b long, common long, total long")


def _differences(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b, label, n, extra, lacking, linked, least_extra, least, extra_all, lacking_all) of hubs a and
    members b with their labels: the size of b's set, how many elements it has that the hub lacks and
    the other way round, whether both are alike, how many of the extra elements and of all differences
    whatever b is to be linked to must share, and the elements of either kind.

    With t(x, y) the greatest symmetric difference of sets that are alike, a fixed part of the sum of
    their sizes, a link of x and y needs 2 * shared >= |differences of x| + |of y| - t(x, y). Sets that
    are alike differ in size by a known factor, which bounds t by x alone; the differences of y are not
    less than those of x less t; and at least one of both is not alike to the hub. Of x at most the part
    1 - similarity is not in y, which bounds the extra elements that they do not share.
    """
    part_of_sum = (1 - similarity) / (1 + similarity)

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = part.num_rows
                hashes, row, alone, side = _two_sets(part, shingle)
                extra = np.bincount(row[alone & side], minlength=rows)
                lacking = np.bincount(row[alone & ~side], minlength=rows)
                total = np.bincount(row, minlength=rows)
                size = (total + extra - lacking) // 2
                differing = extra + lacking
                linked = differing <= part_of_sum * total + SLACK
                most = size * (1 - similarity) / similarity
                # Elements that must be shared, of the extra ones and of all.
                of_extra = np.ceil(extra - size * (1 - similarity) - SLACK)
                of_all = np.where(linked, (differing - part_of_sum * extra) / 2, differing - most)
                least = [np.maximum(0, of_extra), np.maximum(1, np.ceil(of_all - SLACK))]
                lists = []
                for mine, count in ((alone & side, extra), (alone & ~side, lacking)):
                    ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[mine].view(np.int64))))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("a", "b", "label")),
                        *map(pa.array, (size, extra, lacking, linked)),
                        *(pa.array(x.astype(np.int64)) for x in least),
                        *lists,
                    ],
                    names=["a", "b", "label", "n", "extra", "lacking", "linked", "least_extra", "least", "extra_all", "lacking_all"],
                )

    both = _both_texts(pairs, texts).select("a", "b", "label", "text_a", "text_b")
    return both.mapInArrow(
        differ,
        "a long, b long, label long, n long, extra long, lacking long, linked boolean, least_extra long, least long, "
        "extra_all array<long>, lacking_all array<long>",
    )


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in links (a, b); ``root`` is the least node of the component.

    Large-star and small-star steps by turns, in a number that grows with the logarithm of the
    component's size. Each is a minimum by node and a join; a node of very many links is split by
    adaptive execution.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    # No step has more rows than links; so many files hold them.
    files = 1 + edges.count() // ROWS_PER_FILE
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stored(
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct().coalesce(files),
            "large-star",
        )
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = stored(
            large.join(down, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
            .coalesce(files),
            "small-star",
        )
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stored(roots.unionByName(tops).coalesce(files), "roots")


def _relabelled(labels: DataFrame, links: DataFrame, files: int) -> DataFrame:
    """``labels`` after links between labels."""
    roots = connected(links)
    named = labels.join(roots, F.col("label") == roots["node"], "left").select(
        labels["node"], F.coalesce("root", "label").alias("label")
    )
    return stored(named.coalesce(files), "labels")


def _alike(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int, files: int) -> DataFrame:
    """The pairs (a, b) that are alike on full sets."""
    found = _overlaps(pairs, texts, shingle).where(100 * F.col("common") >= percent * F.col("total"))
    # Many tasks find few pairs each.
    return stored(found.select("a", "b").repartition(files), "alike")


def _linked(labels: DataFrame, alike: DataFrame, files: int) -> DataFrame:
    """``labels`` (node, label) after links between nodes."""
    links = (
        alike.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
        .join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
        .where("la <> lb")
        .select(F.col("la").alias("a"), F.col("lb").alias("b"))
    )
    return _relabelled(labels, links, files)


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with their labels, of buckets that hold several."""
    labelled = members.join(labels, "node")
    several = labelled.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    return labelled.join(several.select("bucket"), "bucket")


def _hub_pairs(members: DataFrame, hubs: DataFrame, percent: int, differing: int) -> DataFrame:
    """Pairs of a hub and a member of its bucket in another component, that could be alike: by their
    sizes and by the bits in which they differ."""
    near = (
        (members["bucket"] == hubs["bucket"])
        & (F.col("label") != F.col("l_label"))
        & (100 * F.least("n", "l_n") >= percent * F.greatest("n", "l_n"))
        & (_differing() <= differing)
    )
    pairs = members.join(hubs, near).select(F.least("node", "l_node").alias("a"), F.greatest("node", "l_node").alias("b"))
    return pairs.distinct()


def _meetings(found: DataFrame, similarity: float, files: int) -> DataFrame:
    """Pairs (a, b) of members of different components that could be alike by what they share of their
    ``_differences`` from a hub; some more than once."""
    # A member has a hub for each of its buckets, at most. Of the hubs that two have in common one serves.
    hubs_of = found.groupBy("b").agg(F.collect_set("a").alias("hubs"))
    key = ["a", "kind", "element"]
    kinds = [
        found.select("a", "b", "label", "linked", F.lit(kind).alias("kind"), F.explode(f"{kind}_all").alias("element"))
        for kind in ("extra", "lacking")
    ]
    elements = kinds[0].unionByName(kinds[1])
    useful = elements.groupBy(*key).agg(
        F.min("label").alias("x"), F.max("label").alias("y"), F.min("linked").alias("all_linked"), F.count("*").alias("size")
    )
    useful = stored(useful.where("x < y AND NOT all_linked").select(*key, "size").coalesce(files), "useful")
    # The useful elements of each member, the rarest first. No pair shares any other.
    lists = elements.join(useful, key).groupBy("a", "b").agg(
        *(
            F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("size", "element")))).alias(kind + "_useful")
            for kind in ("extra", "lacking")
        )
    )
    members = found.drop("extra_all", "lacking_all").join(lists, ["a", "b"]).join(hubs_of, "b")
    members = stored(members.coalesce(files), "members")
    shown = ["a", "b", "n", "extra", "lacking", "linked", "label", "hubs"]
    # Members that share no extra element meet on a lacking one. Of an element and those after it in
    # the list there are ``left``; lacking ones that extra ones come on top of are ``also``.
    placed = []
    for kind, also, least in (("extra", F.size("lacking_useful"), "least_extra"), ("lacking", F.lit(0), "least")):
        at = F.posexplode(f"{kind}_useful").alias("at", "found")
        rows = members.select(*shown, "least_extra", "least", F.size(f"{kind}_useful").alias("of"), also.alias("also"), at)
        left = F.col("of") - F.col("at")
        rows = rows.where((left >= F.col(least)) & (left + F.col("also") >= F.col("least")))
        placed.append(rows.select(*shown, F.lit(kind).alias("kind"), "found.element", left.alias("left"), "also"))
    elements = stored(placed[0].unionByName(placed[1]).coalesce(8 * files), "elements")
    right = elements.select(*(F.col(c).alias(f"r_{c}") for c in (*shown, "kind", "element", "left", "also")))
    rest = F.col("extra") + F.col("lacking") + F.col("r_extra") + F.col("r_lacking")
    needed = (rest - (1 - similarity) / (1 + similarity) * (F.col("n") + F.col("r_n"))) / 2 - SLACK
    possible = (
        (F.col("label") != F.col("r_label"))
        & (F.col("a") == F.array_min(F.array_intersect("hubs", "r_hubs")))
        # Two that are both not alike to the hub meet from either side.
        & (F.col("r_linked") | (F.col("b") < F.col("r_b")))
        & (F.least("n", "r_n") >= similarity * F.greatest("n", "r_n") - SLACK)
        & (needed <= F.least("left", "r_left") + F.least("also", "r_also"))
    )
    on = [F.col(c) == F.col(f"r_{c}") for c in key]
    pairs = elements.where("NOT linked").join(right, reduce(lambda x, y: x & y, on) & possible)
    return pairs.select(F.col("b").alias("a"), F.col("r_b").alias("b"))


def _rest_pairs(
    mixed: DataFrame, hubs: DataFrame, texts: DataFrame, shingle: int, similarity: float, files: int
) -> DataFrame:
    """Pairs of members of different components that share a bucket and could be alike by what they
    share of their differences from its hub."""
    of_hub = mixed.join(hubs.select("bucket", F.col("l_node").alias("a")), "bucket").where("node <> a")
    pairs = of_hub.select("a", F.col("node").alias("b"), "label").distinct()
    found = stored(_differences(pairs, texts, shingle, similarity).repartition(files), "differences")
    pairs = _meetings(found, similarity, files)
    # Links to the hub itself that the bits refused.
    missed = found.where("linked").select("a", "b", "label")
    of_hubs = mixed.select(F.col("node").alias("a"), F.col("label").alias("hub_label")).distinct()
    missed = missed.join(of_hubs, "a").where("label <> hub_label")
    return (
        pairs.unionByName(missed.select("a", "b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def components(
    docs: DataFrame,
    similarity: float = 0.85,
    shingle: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, tie, n_shingles, component_id, kept) of each row of ``docs``.

    Words are runs of characters other than ASCII white space, A-Z in lower case. The set of a text
    is its distinct shingles of ``shingle`` words, or all its words as one if it has fewer. Rows are
    linked if intersection over union is at least ``similarity``; ``component_id`` is the least id
    reachable, itself included. Null texts and texts without words have an empty set and no links.
    Equal texts are linked; rows that agree in id and text have the same result; rows without an id
    take part, and count for ``component_id`` only where the whole component has none.
    ``tie`` is the hash of the text. An empty table gives an empty result.
    """
    bands, rows = banding(similarity)
    percent, differing = round(similarity * 100), most_differing(similarity, bands * rows)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    sketched = stored(_sketched(keyed, shingle, bands, rows), "sketches")
    full = sketched.where("n_shingles > 0")
    key = ["set_a", "set_b", "n_shingles"]
    classes = stored(
        full.groupBy(*key).agg(F.min("id").alias("first"), F.min(F.struct("id", "tie")).alias("rep"), F.any_value("bands").alias("bands"), *(F.min(c).alias(c) for c in PACKED))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    # Numbers alone meet by bucket; only members of shared buckets bring their bits along.
    banded = classes.select(F.explode("bands").alias("bucket"), "node")
    crowded = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(banded.join(crowded, "bucket"), "memberships")
    score = shared.groupBy("node").agg(F.sum("size").alias("score"))
    own = classes.select("node", F.col("n_shingles").alias("n"), *PACKED).join(score, "node")
    members = stored(shared.drop("size").join(own, "node"), "buckets")
    files = 1 + members.count() // ROWS_PER_FILE
    wanted = members.select("node").distinct().join(classes.select("node", "rep.id", "rep.tie"), "node")
    same = keyed["tie"].eqNullSafe(wanted["tie"]) & keyed["id"].eqNullSafe(wanted["id"])
    texts = stored(
        keyed.join(wanted, same).select("node", "text", keyed["id"].alias("i")).dropDuplicates(["node"]).drop("i"), "texts"
    )
    labels = stored(members.select("node").distinct().withColumn("label", F.col("node")), "labels")
    # The fullest buckets of its own first; equal ones by hash.
    order = F.struct("score", F.xxhash64("node").alias("h"), "node", "label", "n", *PACKED)
    first, led = None, None
    for _ in range(HUBS):
        mixed = stored(_mixed(members, labels).coalesce(files), "mixed")
        open_members = mixed
        if led is not None:
            # Not from a component that a hub of the bucket is in.
            now = led.join(labels.withColumnRenamed("node", "l_node"), "l_node").select("bucket", "label")
            open_members = mixed.join(now, ["bucket", "label"], "left_anti")
        hubs = stored(
            open_members.groupBy("bucket").agg(F.max(order).alias("l")).select(
                "bucket", *(F.col(f"l.{c}").alias(f"l_{c}") for c in ("node", "label", "n", *PACKED))
            ).coalesce(files),
            "hubs",
        )
        if hubs.isEmpty():
            break
        first = hubs if first is None else first
        led = hubs.select("bucket", "l_node") if led is None else led.unionByName(hubs.select("bucket", "l_node"))
        pairs = stored(_hub_pairs(mixed, hubs, percent, differing).coalesce(files), "pairs")
        alike = _alike(pairs, texts, shingle, percent, files)
        if alike.isEmpty():
            break
        labels = _linked(labels, alike, files)
    if first is not None:
        mixed = stored(_mixed(members, labels).coalesce(files), "mixed")
        pairs = _rest_pairs(mixed, first, texts, shingle, similarity, files)
        alike = _alike(stored(pairs.coalesce(files), "pairs"), texts, shingle, percent, files)
        labels = labels if alike.isEmpty() else _linked(labels, alike, files)
    named = classes.select(*key, "first", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("first").alias("component"))
    found = stored(named.join(least, "label").select("set_a", "set_b", F.col("n_shingles").alias("n"), "component"), "components")
    joined = full.join(
        found, (full["set_a"] == found["set_a"]) & (full["set_b"] == found["set_b"]) & (full["n_shingles"] == found["n"])
    )
    columns = ["id", "tie", "n_shingles", "component"]
    alone = sketched.where("n_shingles = 0").select("id", "tie", "n_shingles", F.col("id").alias("component"))
    return (
        joined.select(full["id"], full["tie"], full["n_shingles"], "component")
        .unionByName(alone.select(*columns))
        .select(
            "id", "tie", "n_shingles", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept")
        )
    )
