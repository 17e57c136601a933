"""Merkle manifests against a build and climb by hand."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(digests):
    """All levels from the leaves to the root."""
    found = [digests]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha("".join(last[k : k + 16])) for k in range(0, len(last), 16)])
    return found


def proof(tree, at, shown):
    """Siblings of a leaf up to the root, and the root that the shown digest gives."""
    siblings = ""
    for level in tree[:-1]:
        run = level[at - at % 16 : at - at % 16 + 16]
        place = at % 16
        siblings += "".join(run[:place] + run[place + 1 :])
        shown = sha("".join(run[:place] + [shown] + run[place + 1 :]))
        at //= 16
    return siblings, shown


def by_hand(rows):
    """(id, leaf, subroot, root, proof, folded_root) of (tree, id, leaf, shown) rows."""
    none_first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v if v is not None else 0)
    trees = sorted({r[0] for r in rows}, key=none_first)
    ordered = {t: sorted((r for r in rows if r[0] == t), key=lambda r: (none_first(r[1]), r[2], none_first(r[3]))) for t in trees}
    built = {t: levels([r[2] for r in ordered[t]]) for t in trees}
    top = levels([built[t][-1][0] for t in trees])
    out = []
    for number, t in enumerate(trees):
        for at, (_, i, leaf, shown) in enumerate(ordered[t]):
            low, folded = proof(built[t], at, shown or leaf)
            high, folded = proof(top, number, folded)
            out.append((i, leaf, built[t][-1][0], top[-1][0], sha(low + high), folded))
    return sorted(out, key=str)


def climbed(spark, rows):
    frame = spark.createDataFrame(rows, "tree string, id long, leaf string, shown string")
    return sorted((tuple(r) for r in merkle.climb(merkle.build(frame)).collect()), key=str)


def some_rows(seed, sizes):
    chance = random.Random(seed)
    rows = []
    for tree, n in sizes.items():
        for _ in range(n):
            leaf = sha(str(chance.random()))
            rows.append((tree, chance.choice([None, chance.randrange(-50, 400)]), leaf, sha(leaf) if chance.random() < 0.3 else None))
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {None: 1, "b": 1},
        {"a": 2},
        {"a": 16, "b": 17, "": 1},
        {"é": 40, "z": 300, "Z": 1, None: 33},
        {f"s{k}": 1 + k % 3 for k in range(40)},
        {"hot": 700, **{f"s{k}": 5 for k in range(17)}},
    ],
)
def test_climb(spark, sizes):
    rows = some_rows(len(sizes), sizes)
    assert climbed(spark, rows) == by_hand(rows)


def test_repeated_rows_are_leaves_of_their_own(spark):
    rows = [("a", 1, sha("x"), None)] * 20 + [("a", 1, sha("y"), None), ("b", None, sha("x"), sha("q"))]
    assert climbed(spark, rows) == by_hand(rows)


def test_no_rows(spark):
    assert climbed(spark, []) == []


def test_tampering_is_found(spark):
    rows = [("a", k, sha(str(k)), sha("other") if k == 37 else None) for k in range(100)]
    assert [r[0] for r in climbed(spark, rows) if r[5] != r[3]] == [37]


def test_digests_of_values(spark):
    rows = [(1, None, "é日", 5), (None, "", None, None), (-3, "1:2", "x" * 100_000, 0)]
    df = spark.createDataFrame(rows, "a long, b string, c string, leaf long")
    got = [r[0] for r in df.select(merkle.leaf_digest(F.col("a"), F.col("b"), F.col("c"))).collect()]
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    assert got == [sha("".join(field(v) for v in r[:3])) for r in rows]
    texts = [("ABC Äß xyz",), ("É",), (None,), ("",), ("ABCXYZ[@`{",), ("İI",)]
    lowered = spark.createDataFrame(texts, "t string").select(merkle.ascii_lower(F.col("t"))).collect()
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert [r[0] for r in lowered] == [t and t.translate(table) for (t,) in texts]
