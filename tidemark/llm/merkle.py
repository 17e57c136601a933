"""Merkle manifest of a table: built level by level, checked by a recursive climb.

Each row is a leaf, each value of a tree column a tree of its own whose leaves ascend by id, and the
roots of the trees (subroots) are the leaves of one more tree, whose root names the whole table. A
level is built from the one below by grouping ``WIDTH`` consecutive nodes. The levels are stored as
node rows that are linked to their parents and carry the digests of their run.

The check is a recursive query over the node rows. It starts from each leaf and goes up by the parent
link; at each step it appends the siblings of the run and folds the digest shown for the leaf into
that of the parent. The leaves of one run have all higher siblings in common, so they travel in one
row: the siblings are carried once for ``WIDTH`` leaves, the folded digests one for each leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

WIDTH = 16
# What number a row has is its task in the upper bits and its place there in the lower 33.
_TASK_BITS = 33
# No tree of WIDTH children a node is higher.
_HIGHEST = 40


def leaf_digest(*columns: Column) -> Column:
    """Digest of values: each as its UTF-8 byte count, a colon and the value, null as a dash."""
    parts = []
    for column in columns:
        value = column.cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # Where all is ASCII the plain function does the same, and faster.
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))


@dataclass(frozen=True)
class Manifest:
    """A built tree of trees."""

    packs: DataFrame  # node, alone, members (place, leaf, id, shown): the leaves by runs
    nodes: DataFrame  # node, parent, place, run, is_subroot: one row for each node that has a parent
    root: str | None  # its digest; None where there is no leaf
    top: str | None  # its node


def _ranked(rows: DataFrame, by: str | None, order: list[str], label: str) -> DataFrame:
    """``rows`` stored with ``at``, the place of each among those of equal ``by``, in this order.

    Rows are dealt by ranges, so one value of ``by`` may fill many tasks; only counts by task and
    value meet in a window.
    """
    keys = [by, *order] if by else order
    row = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
    placed = stored(dealt.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys]).withColumn("row", row), label)
    task = F.shiftright("row", _TASK_BITS)
    group = [F.col(by).alias("group")] if by else [F.lit(0).alias("group")]
    counts = placed.groupBy(*group, task.alias("task")).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("group").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("group", "task", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    same = (task == F.col("task")) & (F.col(by).eqNullSafe(F.col("group")) if by else F.lit(True))
    at = (F.col("before") + F.col("row") - F.col("first")).cast("long").alias("at")
    return placed.join(starts, same).select(*rows.columns, at)


def _node(tree: Column, level: int, at: Column) -> Column:
    return F.concat_ws("/", tree.cast("string"), F.lit(str(level)), at.cast("string"))


def _joined(run: Column) -> Column:
    return F.sha2(F.array_join(run, ""), 256)


def _grown(level: DataFrame, height: int, linked: list[DataFrame], top: bool) -> tuple[DataFrame, int]:
    """The roots (tree, node, digest) of all trees of ``level`` and the height of the highest.

    ``level`` has (tree, at, node, digest, n): n is the number of nodes the tree has there. Node rows
    of the levels passed are added to ``linked``.
    """
    alone = ["tree", "node", "digest"]
    roots, subroots = level.where("n = 1").select(*alone), top
    while True:
        runs = stored(
            level.where("n > 1")
            .groupBy("tree", "n", F.floor(F.col("at") / WIDTH).alias("up"))
            .agg(F.sort_array(F.collect_list(F.struct("at", "node", "digest"))).alias("children")),
            "runs",
        )
        if runs.isEmpty():
            return roots, height
        height += 1
        parent = _node(F.lit("top") if top else F.col("tree"), height, F.col("up"))
        run = F.col("children.digest").alias("run")
        linked.append(
            runs.select(parent.alias("parent"), run, F.posexplode("children.node").alias("place", "node")).withColumn(
                "is_subroot", F.lit(subroots)
            )
        )
        subroots = False
        level = runs.select(
            "tree",
            F.col("up").alias("at"),
            parent.alias("node"),
            _joined(F.col("children.digest")).alias("digest"),
            F.ceil(F.col("n") / WIDTH).alias("n"),
        )
        roots = roots.unionByName(level.where("n = 1").select(*alone))


def build(leaves: DataFrame) -> Manifest:
    """The manifest of ``leaves``: columns tree, id, leaf (its digest) and shown.

    ``shown`` is the digest that a check is to start from, null where it is ``leaf``. Trees are
    ordered by value, null first, and bytewise where they are strings; leaves by id, null first, and
    rows of one id by digest, so repeated rows are leaves next to each other.
    """
    spark = leaves.sparkSession
    rows = _ranked(leaves.select("tree", "id", "leaf", "shown"), "tree", ["id", "leaf", "shown"], "leaves")
    rows = rows.withColumnRenamed("tree", "value")
    sizes = rows.groupBy("value").agg(F.count("*").alias("n"))
    trees = stored(_ranked(sizes, None, ["value"], "values").withColumnRenamed("at", "tree"), "trees")
    same = rows["value"].eqNullSafe(trees["value"])
    numbered = rows.join(trees, same).select("tree", "n", "at", "id", "leaf", "shown")
    member = F.struct((F.col("at") % WIDTH).cast("int").alias("place"), "leaf", "id", "shown")
    packs = stored(
        numbered.groupBy("tree", "n", F.floor(F.col("at") / WIDTH).alias("up"))
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .withColumn("alone", F.col("n") == 1),
        "packs",
    )
    # A lone leaf is its tree's root as it is; else the run's digest is a node of level 1.
    digest = F.when(F.col("alone"), F.col("members")[0]["leaf"]).otherwise(_joined(F.col("members.leaf")))
    node = _node(F.col("tree"), 1, F.col("up"))
    first = packs.select(
        "tree", F.col("up").alias("at"), node.alias("node"), digest.alias("digest"), F.ceil(F.col("n") / WIDTH).alias("n")
    )
    linked: list[DataFrame] = []
    roots, height = _grown(first, 1, linked, top=False)
    roots = stored(roots, "subroots")
    # The subroots in the order of their trees are the leaves of the top tree.
    own = roots.select(F.lit(0).alias("tree"), F.col("tree").alias("at"), "node", "digest", F.lit(roots.count()).alias("n"))
    tops, _ = _grown(own, 0, linked, top=True)
    last = tops.first()
    nodes = spark.createDataFrame([], "parent string, run array<string>, place int, node string, is_subroot boolean")
    for part in linked:
        nodes = nodes.unionByName(part)
    return Manifest(
        packs.select(node.alias("node"), "alone", "members"),
        stored(nodes, "nodes"),
        last["digest"] if last else None,
        last["node"] if last else None,
    )


# What the parent's digest becomes with the digest ``x`` in a run at a place.
_FOLD = "sha2(concat(array_join(slice(run, 1, {0}), ''), {1}, array_join(slice(run, {0} + 2, size(run)), '')), 256)"
_START = f"""
    transform(members, (m, i) -> unhex(CASE WHEN alone THEN coalesce(m.shown, m.leaf)
      ELSE {_FOLD.format("i", "coalesce(m.shown, m.leaf)")} END))
"""
# Each step goes from a node to its parent. Digests on the way are kept as bytes. The join is always a
# shuffle: neither side has a bound.
_CLIMB = """
    WITH RECURSIVE climb(pack, node, folded, siblings, subroot) MAX RECURSION LEVEL {most} AS (
      SELECT node AS pack, node, folded, unhex('') AS siblings, CAST(NULL AS STRING) AS subroot FROM {{starts}}
      UNION ALL
      SELECT /*+ MERGE(n) */ c.pack, n.parent,
        transform(c.folded, f -> unhex({fold})),
        concat(c.siblings,
          unhex(concat(array_join(slice(run, 1, place), ''), array_join(slice(run, place + 2, size(run)), '')))),
        CASE WHEN n.is_subroot THEN n.run[n.place] ELSE c.subroot END
      FROM climb c JOIN {{nodes}} n ON n.node = c.node
    )
    SELECT pack, folded, siblings, subroot FROM climb WHERE node = '{top}'
"""


def climb(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root) of each leaf.

    ``proof`` is the digest of the siblings from the leaf up to the root, in order; ``folded_root``
    what the digest shown for the leaf makes of the root with the stored siblings. An empty manifest
    gives no row.
    """
    spark = manifest.packs.sparkSession
    packs = manifest.packs.withColumn("run", F.col("members.leaf"))
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    # The rows are as many as runs times levels; the levels are bounded.
    spark.conf.set(limit, "-1")
    try:
        query = _CLIMB.format(most=_HIGHEST, top=manifest.top, fold=_FOLD.format("place", "lower(hex(f))"))
        starts = packs.select("node", F.expr(_START).alias("folded"))
        done = stored(spark.sql(query, starts=starts, nodes=manifest.nodes), "climbed")
    finally:
        spark.conf.set(limit, before)
    root = F.lit(manifest.root)
    above = F.lower(F.hex("siblings"))
    others = F.array_join(F.filter("run", lambda x, i: (i != F.col("place")) & ~F.col("alone")), "")
    each = (
        packs.withColumnRenamed("node", "pack")
        .join(done, "pack")
        .select("alone", "run", "subroot", above.alias("above"), F.posexplode(F.arrays_zip("members", "folded")).alias("place", "m"))
    )
    return each.select(
        "m.members.id",
        "m.members.leaf",
        F.coalesce("subroot", root).alias("subroot"),
        root.alias("root"),
        F.sha2(F.concat(others, "above"), 256).alias("proof"),
        F.lower(F.hex("m.folded")).alias("folded_root"),
    )
