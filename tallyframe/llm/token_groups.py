"""N-gram Jaccard join by a token-group matrix: similar documents form groups, the matrix holds each group's union of
shingles, a bound on the overlap of a document with a group's union says which groups are opened, and an opened
group compares by differences from its centre."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import map_batches, mix, settle, table
from tallyframe.llm.links import group_links, hot_join, part_centres
from tallyframe.llm.near_dedup import components, shingle_sets

_PART, _SUM = np.uint64(0x9FB2_1C65_1E98_DF25), np.uint64(0xD1B5_4A32_D192_ED03)
KEY = ["n", "sum_a", "sum_b"]


def size_classes(percent: int) -> np.ndarray:
    """Least size of each class. Two sets that link lie in one class or in neighbouring ones."""
    least = [1]
    while least[-1] < 1 << 40:
        least.append(least[-1] * 100 // percent + 1)
    return np.array(least, np.int64)


def most_apart(percent: int, sizes):
    """The most elements that two sets which link may have apart, by the sum of their sizes."""
    return sizes * (100 - percent) // (100 + percent)


def _part_counts(percent: int) -> np.ndarray:
    """Parts of scheme k, which serves pairs whose smaller set is in class k: two more than they may have elements
    apart, so two parts at least are equal. 0 where only equal sets link."""
    largest = size_classes(percent)[1:] - 1
    apart = most_apart(percent, largest + largest * 100 // percent)
    return np.where(apart > 0, apart + 2, 0)


def part_signatures(values: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For each set the signatures of its parts, and len + 1 offsets. A set's elements are dealt to parts by their hash,
    once for pairs with its own class or a larger set's, once for those with the class below. As two parts of a pair are equal, a
    single empty part needs no signature; a set with more of them has one for each."""
    sizes, counts = np.diff(offsets), _part_counts(percent)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found, of = [], []
    for below in (0, 1):
        scheme = np.searchsorted(size_classes(percent), sizes, "right") - 1 - below
        parts = np.where((scheme >= 0) & (sizes > 0), counts[np.maximum(scheme, 0)], 0)
        first = np.concatenate(([0], np.cumsum(parts)))
        dealt = parts[owner] > 0
        held, by = values[dealt], owner[dealt]
        salt = mix(scheme[by].astype(np.uint64) + _PART)
        place = first[by] + ((mix(held ^ salt) >> np.uint64(32)) * parts[by].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        sums, filled = np.zeros(first[-1], np.uint64), np.bincount(place, minlength=first[-1])
        np.add.at(sums, place, mix(held ^ _SUM))
        sets = np.repeat(np.arange(len(sizes)), parts)
        name = (scheme[sets].astype(np.uint64) << np.uint64(32)) + (np.arange(first[-1]) - first[sets]).astype(np.uint64)
        empty = np.bincount(sets[filled == 0], minlength=len(sizes))
        kept = (filled > 0) | (empty[sets] > 1)
        found.append(mix(sums + mix(name + _SUM))[kept])
        of.append(sets[kept])
    found, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return found[order], np.searchsorted(of[order], np.arange(len(sizes) + 1))


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _identity(values: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Size and two sums of each set: equal for equal sets alone, but for hash collisions over 128 bits."""
    sizes = np.diff(offsets)
    filled, sums = np.flatnonzero(sizes), [np.zeros(len(sizes), np.uint64) for _ in range(2)]
    for total, salt in zip(sums, (_PART, _SUM)):
        if len(filled):
            total[filled] = np.add.reduceat(mix(values ^ mix(salt + np.zeros(1, np.uint64))[0]), offsets[:-1][filled])
    return [sizes, sums[0].view(np.int64), sums[1].view(np.int64)]


def part_table(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, sum_a, sum_b, parts: one row for each row of docs."""

    def build(batch: pa.RecordBatch) -> list:
        values, offsets = shingle_sets(batch.column("text"), words)
        return [batch.column("doc_id"), *_identity(values, offsets), _lists(*part_signatures(values, offsets, percent))]

    return map_batches(docs.select("doc_id", "text"), build, "doc_id long, n long, sum_a long, sum_b long, parts array<long>")


def _set_table(docs: DataFrame, words: int) -> DataFrame:
    def build(batch: pa.RecordBatch) -> list:
        values, offsets = shingle_sets(batch.column("text"), words)
        return [*_identity(values, offsets), _lists(values, offsets)]

    return map_batches(docs.select("text"), build, "n long, sum_a long, sum_b long, shingles array<long>")


def token_groups(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """shared (node, part): the parts that several nodes have; parts (part, size) -> node, group. Similar documents share parts, so of
    each part's documents the one with the most company in all its parts, as the original of many changed copies has, is the part's
    centre, and a document joins the best centre of its parts. A group has its centre's name."""
    best = hot_join(shared, part_centres(shared, parts), ["part"], parts, "node").groupBy("node").agg(F.max("centre").alias("centre"))
    return best.select("node", (-F.col("centre.last")).alias("group"))


def opened_groups(grouped: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """grouped (node, n, group) -> (node, group) of the documents that may link with a member of another group.

    The matrix has a row for each shingle and group whose union holds it. A document of n shingles that links with any
    member shares at least percent / 100 * n of them with the group's union, so at most `apart` of its shingles are missing there. Shingles
    of one group only are missing in every other: a document with more than `apart` of them links with no other group and leaves
    the matrix, which can leave others alone in turn. The first 2 * (apart + 1) shingles, those of the fewest groups first, are then looked up; groups where more than `apart` of these are missing stay shut, with
    a tighter count once the sizes of a group's members are known. A pair of groups is opened from the one with the lesser name,
    which finds each link once."""
    apart = F.floor(F.col("n") * (100 - percent) / 100)
    for _ in range(_ROUNDS):
        known, _ = _shared_shingles(grouped, sets)
        known = known.groupBy("node").agg(F.count(F.lit(1)).alias("known"))
        grouped = settle(grouped.join(known, "node").where(F.col("n") - F.col("known") <= apart).select("node", "n", "group"))
        sets = sets.join(grouped.select("node"), "node", "left_semi")
    ranges = grouped.groupBy("group").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    rows, matrix = _shared_shingles(grouped, sets)
    mine = Window.partitionBy("node")
    rows = rows.join(grouped.select("node", "n", F.col("group").alias("own")), "node")
    place = F.row_number().over(mine.orderBy("groups", "x")) + F.col("n") - F.count(F.lit(1)).over(mine)
    looked = rows.withColumn("place", place).withColumn("upto", F.least(F.col("n"), 2 * (apart + 1))).where("place <= upto")
    held = looked.select("x", "node", "own", "n", "upto").join(matrix, "x").where("group > own")
    counted = held.groupBy("node", "group", "n", "upto").agg(F.count(F.lit(1)).alias("held")).join(ranges, "group")
    # A member that links has percent / 100 * n shingles or more, and shares percent / (100 + percent) of both sizes.
    smallest = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    shared = F.ceil((F.col("n") + smallest) * percent / (100 + percent))
    fits = (F.col("least") * percent <= F.col("n") * 100) & (F.col("n") * percent <= F.col("most") * 100)
    return counted.where(fits & (F.col("upto") - F.col("held") <= F.col("n") - shared)).select("node", "group")


def _shared_shingles(grouped: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, x, groups) for the shingles that several groups' unions hold, and the matrix (group, x)."""
    matrix = settle(sets.join(grouped, "node").select("group", F.explode("shingles").alias("x")).distinct())
    spread = matrix.groupBy("x").agg(F.count(F.lit(1)).alias("groups")).where("groups > 1")
    return sets.select("node", F.explode("shingles").alias("x")).join(spread, "x"), matrix


#: How often documents leave the matrix before it is searched.
_ROUNDS = 2


def jaccard_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_shingles, component_id; one row for each row read.

    Words are runs outside 20 and 09-0D, A-Z lower-cased; a text's set holds its distinct shingles of `words`
    words (64-bit hashes), a shorter text its one whole sequence; null, empty and blank texts have an empty set and are linked with
    nothing. Two documents link when 100 * shared >= percent * united; component_id is the smallest doc_id reachable by links. The
    join is exact: it has no sketch and no cap.

    1. Documents with equal sets are one node.
    2. Sets are dealt to parts (part_signatures): sets that link have an equal part. Nodes that share none are done.
    3. The other nodes form groups (token_groups); the token-group matrix says which groups a node opens besides
       its own (opened_groups); opened groups compare their nodes (group_links); links become components.

    Rows of one doc_id are linked with each other. A null doc_id is in no component (component_id null). Other columns are ignored; an
    empty table gives an empty result."""
    docs = docs.select("doc_id", "text")
    rows = settle(part_table(docs, words, percent))
    known = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy(*KEY).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("size"))
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()))
    heads = known.join(classes, [*KEY, "doc_id"]).select("node", "parts")
    members = heads.select("node", F.explode("parts").alias("part"))
    crowded = members.groupBy("part").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size")).where("low < high").select("part", "size")
    parts = settle(crowded)
    shared = settle(members.join(parts.select("part"), "part"))
    nodes = settle(classes.join(shared.select("node").distinct(), "node", "left_semi"))
    texts = docs.join(nodes.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = settle(_set_table(texts, words).join(nodes.select(*KEY, "node"), KEY).dropDuplicates(["node"]).select("node", "shingles"))
    grouped = settle(token_groups(shared, parts).join(nodes.select("node", "n"), "node"))
    opened = opened_groups(grouped, sets, percent)
    own = grouped.select("node", "group").union(grouped.select(F.col("group").alias("node"), "group")).distinct()
    links = group_links(settle(own.union(opened).distinct()), sets, percent)
    several = known.groupBy("doc_id").agg(F.min(F.struct(*KEY)).alias("one"), F.max(F.struct(*KEY)).alias("two")).where("one <> two").select("doc_id")
    same = known.join(several, "doc_id", "left_semi").select("doc_id", *KEY).join(classes.select(*KEY, "node"), KEY).select("doc_id", "node")
    same = same.join(same.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b")
    joined = components(settle(links.union(same)))
    firsts = joined.join(classes.select("node", "doc_id"), "node")
    roots = classes.select(F.col("node").alias("component"), F.col("doc_id").alias("root"))
    least = firsts.groupBy("component").agg(F.min("doc_id").alias("least")).join(roots, "component").select("component", F.least("least", "root").alias("component_id"))
    named = joined.join(least, "component").select("node", "component_id").union(least.select(F.col("component").alias("node"), "component_id")).dropDuplicates(["node"])
    labels = classes.join(named, "node", "left").select(*KEY, F.coalesce("component_id", "doc_id").alias("component_id"))
    out = hot_join(rows.drop("parts"), labels, KEY, classes.select(*KEY, "size"), "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), words=3, percent=90)


OP13_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
e AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS x FROM w WHERE len(ws) >= 3
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 2),
n AS (SELECT doc_id, count(x) AS n FROM w LEFT JOIN e USING (doc_id) GROUP BY doc_id),
k AS (SELECT doc_id, x FROM e WHERE x IN (SELECT x FROM e GROUP BY x HAVING count(*) > 1)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM k a JOIN k b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n s ON s.doc_id = p.a JOIN n t ON t.doc_id = p.b WHERE 100 * shared >= 90 * (s.n + t.n - shared)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reach FROM n UNION SELECT r.node, both_ways.b FROM r JOIN both_ways ON both_ways.a = r.reach),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT doc_id, n AS n_shingles, component_id FROM n JOIN c ON node = doc_id
"""

QUERIES = {"op13_jaccard_join": op13_jaccard_join}
ORACLES = {"op13_jaccard_join": OP13_SQL}
