"""Links inside groups of documents that were found to be alike: joins that spread frequent keys, centres of groups,
and the exact comparison of a group's members by their differences from its centre."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import settle

#: A key with at least this share of all rows is salted; there are at most a thousand such keys.
HOT_KEYS, SALTS = 1_000, 64


def hot_join(large: DataFrame, small: DataFrame, keys: list[str], sizes: DataFrame, by: str, how: str = "inner") -> DataFrame:
    """large with the one row of small for its keys. sizes (keys, size) counts large's rows of a key: keys with a thousandth of
    them or more, at most a thousand, are broadcast, their rows scatter over salts, and their row of small is copied to each."""
    hot = F.broadcast(sizes.where(F.col("size") * HOT_KEYS >= sizes.agg(F.sum("size")).scalar()).select(*keys, F.lit(True).alias("_hot")))
    salted = large.join(hot, keys, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.hash(by), F.lit(SALTS))).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = small.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted.join(copied, [*keys, "_salt"], how).drop("_salt")


def part_centres(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """shared (node, part), parts (part, size) -> part, centre: of each part's documents the one with the most company in all its
    parts, the smallest of equal ones, as a struct (company, last) that orders centres; its node is -last."""
    company = hot_join(shared, parts, ["part"], parts, "node").groupBy("node").agg(F.sum("size").alias("company"))
    ranked = shared.join(company, "node").select("part", "node", F.struct("company", (-F.col("node")).alias("last")).alias("rank"))
    return ranked.groupBy("part").agg(F.max("rank").alias("centre"))


def group_links(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """entries (node, group): documents that an opened group compares with each other, the group being named by its centre ->
    links (a, b), as many as join all that are linked by any pair of them.

    Every document is compared with its centre by full sets and kept as the difference: the shingles that only one of the two
    has. Two documents differ in what their differences do not share, so a pair links when
    2 * shared >= |difference a| + |difference b| - apart, which is exact. Pairs that both link with the centre are joined by it. Of all
    others, one that links shares a difference shingle among the first of both, those of the fewest documents in the group first;
    with places p and q there (from 0), p + q <= apart and 2 * (|difference| - place) >= |difference a| + |difference b| - apart hold.
    So the many changed copies of one text, which share nearly all their shingles, meet by the few that tell them apart."""
    sizes = entries.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    crowd = settle(sizes.where("size > 1"))
    others = hot_join(entries.where("node <> group"), crowd.select("group"), ["group"], crowd, "node")
    centres = sets.join(crowd.select(F.col("group").alias("node")), "node").select(F.col("node").alias("group"), F.col("shingles").alias("centre"))
    met = hot_join(others.join(sets, "node"), centres, ["group"], crowd, "node")
    sized = met.select("group", "node", F.size("shingles").cast("long").alias("n"), F.size("centre").cast("long").alias("n_c"), F.concat(F.array_except("shingles", "centre"), F.array_except("centre", "shingles")).alias("diff"))
    sized = sized.withColumn("size", F.size("diff").cast("long"))
    kept = settle(sized.withColumn("linked", (100 + percent) * F.col("size") <= (100 - percent) * (F.col("n") + F.col("n_c"))).drop("n_c"))
    stars = kept.where("linked").select(F.col("node").alias("a"), F.col("group").alias("b"))

    apart = most_apart_column(percent, F.col("n") + F.floor(F.col("n") * 100 / percent))
    alone = kept.groupBy("group").agg(F.count(F.lit(1)).alias("k"), F.min("linked").alias("all_linked")).where("k > 1 AND NOT all_linked").select("group", F.col("k").alias("size"))
    tokens = hot_join(kept, alone.select("group"), ["group"], alone, "node").select("group", "node", "n", "size", "linked", F.explode("diff").alias("x"))
    often = tokens.groupBy("group", "x").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    mine = Window.partitionBy("group", "node")
    place = F.row_number().over(mine.orderBy("often", "x")) - 1 + F.col("size") - F.count(F.lit(1)).over(mine)
    placed = settle(tokens.join(often, ["group", "x"]).withColumn("place", place).withColumn("apart", apart).where("place <= apart").drop("often"))
    first = placed.where("2 * place <= apart").select("group", "x", *[F.col(name).alias(f"{name}_a") for name in ("node", "n", "size", "linked", "place")])
    both = first.join(placed.select("group", "x", "node", "n", "size", "linked", "place"), ["group", "x"])
    needed = F.col("size_a") + F.col("size") - most_apart_column(percent, F.col("n_a") + F.col("n"))
    near = (2 * (F.col("size_a") - F.col("place_a")) >= needed) & (2 * (F.col("size") - F.col("place")) >= needed)
    pairs = both.where((F.col("node_a") != F.col("node")) & ~(F.col("linked_a") & F.col("linked")) & near)
    pairs = pairs.groupBy(F.least("node_a", "node").alias("a"), F.greatest("node_a", "node").alias("b")).agg(F.min("group").alias("group"))
    left = kept.select("group", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("diff").alias("diff_a"))
    right = kept.select("group", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("diff").alias("diff_b"))
    sure = pairs.join(left, ["group", "a"]).join(right, ["group", "b"])
    missing = F.size("diff_a") + F.size("diff_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b"))
    return stars.union(sure.where((100 + percent) * missing <= (100 - percent) * (F.col("n_a") + F.col("n_b"))).select("a", "b"))


def most_apart_column(percent: int, sizes: Column) -> Column:
    return F.floor(sizes * (100 - percent) / (100 + percent))
