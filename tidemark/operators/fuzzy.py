"""Name matching across sources by edit distance or by words in common, as an equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import deletion_variants


def _distinct_names(df: DataFrame, name: Column) -> DataFrame:
    """Each name once, with the number of rows that carry it; a NULL name has no variant to meet."""
    return df.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))


def match_names(
    left: DataFrame, left_name: Column, right: DataFrame, right_name: Column, max_distance: int = 1
) -> DataFrame:
    """Pairs of distinct names within ``max_distance`` edits, with the rows behind each side.

    Names are first reduced to distinct values, so a name held by a third of all rows is one row
    here. Each then joins through its deletion variants. Only names that share a variant meet,
    and a variant is shared by close names alone, whatever a name's frequency. No block is
    compared with itself and no match within the distance is lost.
    """
    sides = []
    for side, df, name in (("left", left, left_name), ("right", right, right_name)):
        names = _distinct_names(df, name).select(
            F.col("name").alias(f"{side}_name"), F.col("n").alias(f"{side}_rows")
        )
        variants = F.explode(deletion_variants(F.col(f"{side}_name"), max_distance))
        sides.append(names.withColumn("variant", variants))
    pairs = sides[0].join(sides[1], "variant").drop("variant")
    distance = F.levenshtein(F.col("left_name"), F.col("right_name"), max_distance)
    close = pairs.withColumn("distance", distance).where(F.col("distance") >= 0)
    # A pair meets once per shared variant; the counts are functions of the names.
    return close.groupBy("left_name", "right_name").agg(
        F.first("left_rows").alias("left_rows"),
        F.first("right_rows").alias("right_rows"),
        F.first("distance").alias("distance"),
    )


def match_token_sets(
    left: DataFrame, left_name: Column, right: DataFrame, right_name: Column, percent: int = 80
) -> DataFrame:
    """Pairs of distinct names whose sets of words have ``percent`` of their union in common, at least, with
    the rows behind each side, the words in common and the words of both.

    Words are parted by blanks and taken as they are; a name without words meets nothing. The words of
    a name are ordered from the rarest on. Two names alike must share one of the first few, fewer
    the higher the percentage, so names join through these and through words that are rare; a pair is then
    counted exactly. No pair of the wanted likeness is lost.
    """
    sides, words = {}, F.filter(F.array_distinct(F.split("name", r"\s+")), lambda w: w != "")
    for side, df, name in (("left", left, left_name), ("right", right, right_name)):
        names = _distinct_names(df, name).withColumn("words", words)
        sides[side] = names.where((F.size("words") > 0) & F.col("name").isNotNull())
    each = {side: names.select("name", F.explode("words").alias("word")) for side, names in sides.items()}
    rarity = each["left"].unionByName(each["right"]).groupBy("word").agg(F.count(F.lit(1)).alias("in_names"))
    first = {}
    for side, names in sides.items():
        ordered = (
            each[side].join(rarity, "word")
            .groupBy("name")
            .agg(F.sort_array(F.collect_list(F.struct("in_names", "word"))).alias("o"))
            .select("name", F.col("o.word").alias("ordered"))
        )
        size = F.size("ordered")
        shown = size - F.ceil(size * percent / 100).cast("int") + 1
        prefix = F.explode(F.slice("ordered", 1, shown)).alias("word")
        first[side] = ordered.join(names.select("name", "n"), "name").select(
            F.col("name").alias(f"{side}_name"), F.col("n").alias(f"{side}_rows"), F.col("ordered").alias(f"{side}_words"), prefix
        )
    sizes = F.size("left_words"), F.size("right_words")
    lengths = 100 * F.least(*sizes) >= percent * F.greatest(*sizes)
    pairs = first["left"].join(first["right"], "word").where(lengths)
    common = F.size(F.array_intersect("left_words", "right_words"))
    counted = pairs.withColumn("common", common).withColumn("total", sizes[0] + sizes[1] - F.col("common"))
    close = counted.where(100 * F.col("common") >= percent * F.col("total"))
    # A pair meets once per shared word of both beginnings; the counts are functions of the names.
    columns = ("left_rows", "right_rows", "common", "total")
    return close.groupBy("left_name", "right_name").agg(*[F.first(c).alias(c) for c in columns])
