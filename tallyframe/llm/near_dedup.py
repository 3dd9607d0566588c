"""MinHash near-dedup by fast similarity sketching: rounds of hashed bin placement fill every coordinate, banding
proposes groups, full shingle sets confirm the links in them, and links become components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import LOWER, SPACED, first_rows, map_batches, mix, numbered, set_aside, settle, table, text_bytes, word_hashes, word_spans
from tallyframe.llm.links import group_links, hot_join, part_centres

COORDINATES, BANDS = 252, 42
_EMPTY = np.uint64(0xFFFF_FFFF_FFFF_FFFF)
_SHINGLE = mix(np.arange(1, 64, dtype=np.uint64) * np.uint64(0xD6E8_FEB8_6659_FD93)) | np.uint64(1)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit hashes of the word shingles of each text, text by text, and len + 1 offsets into them."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, SPACED)
    hashes = word_hashes(data, starts, ends)
    count = np.diff(first)
    if len(hashes) >= words:
        rolled = sum((mix(hashes[k : len(hashes) - words + 1 + k]) * _SHINGLE[k] for k in range(words)), np.zeros(1, np.uint64))
    else:
        rolled = np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(count)), np.maximum(count - words + 1, 0))
    at = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(np.maximum(count - words + 1, 0))[:-1])), np.maximum(count - words + 1, 0))
    values = mix(rolled[first[owner] + at]) if len(owner) else np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        whole = np.array([
            int(sum((mix(hashes[first[d] + k : first[d] + k + 1]) * _SHINGLE[k] for k in range(count[d])), np.zeros(1, np.uint64))[0]) for d in short
        ], np.uint64) + count[short].astype(np.uint64)
        values, owner = np.concatenate((values, mix(whole))), np.concatenate((owner, short))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    if len(values):
        new = np.concatenate(([True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])))
        values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(count) + 1))


def sketches(values: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """One row of `size` coordinates for each set. Round r < size places every element in a hashed bin; round
    size + r places all of them in bin r, so after 2 * size rounds each bin of a set with an element is full.
    A bin keeps the smallest (round, hash); a set leaves when its bins are full."""
    sets = len(offsets) - 1
    out = np.full(sets * size, _EMPTY)
    owner = np.repeat(np.arange(sets), np.diff(offsets))
    for round_ in range(2 * size):
        if not len(owner):
            break
        drawn = mix(values ^ mix(np.full(1, round_ + 1, np.uint64))[0])
        value = (mix(drawn) >> np.uint64(16)) | (np.uint64(round_) << np.uint64(48))
        place = ((drawn >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64) if round_ < size else np.int64(round_ - size)
        np.minimum.at(out, owner * size + place, value)
        full = (out.reshape(sets, size) != _EMPTY).all(1)
        left = ~full[owner]
        owner, values = owner[left], values[left]
    return out.reshape(sets, size)


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    rows = sketch.shape[1] // bands
    keys = np.zeros((len(sketch), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for row in range(rows):
        keys = mix(keys * np.uint64(0x9E37_79B9_7F4A_7C15) + sketch[:, row::rows])
    return keys


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def set_summaries(docs: DataFrame, words: int, coordinates: int = COORDINATES, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, two 64-bit sums that tell sets apart, and the band keys (none for an empty set)."""

    return map_batches(docs.select("doc_id", "text"), lambda batch: [batch.column("doc_id"), *_summary(*shingle_sets(batch.column("text"), words), coordinates, bands)], _SUMMARY)


_SUMMARY = "doc_id long, n_shingles long, sum_a long, sum_b long, bands array<long>"


def _summary(values: np.ndarray, offsets: np.ndarray, coordinates: int, bands: int) -> list:
    sizes = np.diff(offsets)
    filled = np.flatnonzero(sizes)
    sums = [np.zeros(len(sizes), np.uint64) for _ in range(2)]
    if len(filled):
        for at, salt in enumerate((0xA076_1D64_78BD_642F, 0xE703_7ED1_A0B4_28DB)):
            sums[at][filled] = np.add.reduceat(mix(values ^ np.uint64(salt)), offsets[:-1][filled])
    keys = band_keys(sketches(values, np.concatenate(([0], np.cumsum(sizes[filled]))), coordinates), bands)
    ends = np.concatenate(([0], np.cumsum(np.where(sizes > 0, bands, 0))))
    return [sizes, sums[0].view(np.int64), sums[1].view(np.int64), _lists(keys.reshape(-1), ends)]


def list_summaries(sets: DataFrame, coordinates: int = COORDINATES, bands: int = BANDS) -> DataFrame:
    """set_summaries of (doc_id, shingles)."""

    def summarise(batch: pa.RecordBatch) -> list:
        lists = batch.column("shingles")
        offsets = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
        return [batch.column("doc_id"), *_summary(np.asarray(lists.flatten()).astype(np.int64).view(np.uint64), offsets, coordinates, bands)]

    return map_batches(sets.select("doc_id", "shingles"), summarise, _SUMMARY)


def shingle_lists(docs: DataFrame, words: int) -> DataFrame:
    def build(batch: pa.RecordBatch) -> list:
        return [batch.column("doc_id"), _lists(*shingle_sets(batch.column("text"), words))]

    return map_batches(docs.select("doc_id", "text"), build, "doc_id long, shingles array<long>")


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, component): the smallest node that each node is joined to. Large stars and small
    stars alternate until only stars are left; each round's links are settled, and no node's neighbours are gathered."""
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("v <> m").distinct()
    while True:
        both = edges.union(edges.select("m", "v").toDF("v", "m"))
        low = both.groupBy("v").agg(F.least(F.min("m"), F.col("v")).alias("low"))
        large = both.join(low, "v").where("m > v").select(F.col("m").alias("v"), F.col("low").alias("m"))
        large = large.union(low.where("low < v")).where("v <> m").distinct()
        least = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(least, "v").where("m <> low").select(F.col("m").alias("v"), F.col("low").alias("m")).union(least).distinct()
        edges = settle(small)
        if edges.join(edges.select(F.col("v").alias("m")).distinct(), "m", "left_semi").isEmpty():
            return edges.select(F.col("v").alias("node"), F.col("m").alias("component"))


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, coordinates: int = COORDINATES, bands: int = BANDS) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_shingles, component_id, kept; one row for each row read.

    Words are runs outside 20 and 09-0D, A-Z lower-cased; a text's set holds its distinct shingles of `words`
    words (hashed to 64 bits), a shorter text its one whole sequence; null, empty and blank texts have an empty
    set, are linked with nothing and are kept. Rows are linked when 100 * shared >= percent * united on the
    full sets.

    1. Rows with equal sets form a class; its smallest doc_id stands for it, so copies are never paired.
    2. Representatives meet in bands of their sketch (252 coordinates in 42 bands: a pair at exactly 0.8 misses all
       of them 3 times in 10^6).
    3. Each band has a centre, its member with the most company in all its bands, as the original of many changed copies has.
       The members of all bands with one centre are a group, so the many bands of such copies are few groups.
    4. Every pair of a group is compared, or ruled out exactly by the differences from the centre (links.group_links),
       unless both link with the centre and so are joined already. No pair is left out.

    Rows that share a doc_id count as one document, whose set unites theirs. A null doc_id is in no component and kept; other columns
    are ignored; an empty table gives an empty result."""
    docs = docs.select("doc_id", "text")
    rows = sums = settle(set_summaries(docs, words, coordinates, bands))
    key = ["n_shingles", "sum_a", "sum_b"]
    repeated = settle(sums.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1").select("doc_id"))
    united = None
    if not repeated.isEmpty():
        parts = shingle_lists(docs.join(repeated, "doc_id", "left_semi"), words).select("doc_id", F.explode_outer("shingles").alias("x"))
        united = settle(parts.distinct().groupBy("doc_id").agg(F.collect_set("x").alias("shingles")))
        of_united = settle(list_summaries(united, coordinates, bands))
        single, docs = sums.join(repeated, "doc_id", "left_anti"), docs.join(repeated, "doc_id", "left_anti")
        sums = settle(single.unionByName(of_united))
        rows = single.unionByName(rows.select("doc_id").join(of_united, "doc_id"))
    classes = settle(sums.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep")).where("rep IS NOT NULL"))
    heads = sums.select("doc_id", "n_shingles", "bands").join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    members = heads.select(F.explode("bands").alias("part"), F.col("doc_id").alias("node"))
    met = members.groupBy("part").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size"))
    crowded = settle(met.where("low < high").select("part", "size"))
    shared = settle(members.join(crowded.select("part"), "part"))
    wanted = settle(shared.select(F.col("node").alias("doc_id")).distinct())
    sets = shingle_lists(docs.join(wanted, "doc_id", "left_semi"), words)
    sets = settle(sets if united is None else sets.unionByName(united.join(wanted, "doc_id", "left_semi")))
    entries = hot_join(shared, part_centres(shared, crowded), ["part"], crowded, "node").select("node", (-F.col("centre.last")).alias("group"))
    entries = settle(entries.union(entries.select("group", "group")).distinct())
    links = settle(group_links(entries, sets.select(F.col("doc_id").alias("node"), "shingles"), percent))
    joined = settle(components(links))
    groups = classes.join(joined, F.col("rep") == F.col("node"), "left").select(*key, F.coalesce("component", "rep").alias("rep"))
    return rows.drop("bands").join(groups, key, "left").select(
        "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("component_id"), F.coalesce(F.col("doc_id") == F.coalesce("rep", "doc_id"), F.lit(True)).alias("kept")
    )


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id, one without an id only if no other has one.
    Each row is a document of its own here, whatever its doc_id. All columns stay, whatever their names."""
    docs, restored = set_aside(docs, "_row")
    rows = numbered(docs)
    groups = near_groups(rows.select(F.col("_row").alias("doc_id"), "text"), words, percent)
    return restored(first_rows(rows, groups.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), words=4, percent=80)


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS k FROM w WHERE len(ws) >= 4),
g AS (SELECT doc_id, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o AS x FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
e AS (SELECT DISTINCT doc_id, x FROM g WHERE x IS NOT NULL UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(x) AS n FROM w LEFT JOIN e USING (doc_id) GROUP BY doc_id),
rare AS (SELECT x FROM e GROUP BY x HAVING count(*) > 1),
k AS (SELECT e.doc_id, e.x FROM e JOIN rare USING (x)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM k a JOIN k b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n s ON s.doc_id = p.a JOIN n t ON t.doc_id = p.b WHERE 100 * shared >= 80 * (s.n + t.n - shared)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reach FROM n UNION SELECT r.node, both_ways.b FROM r JOIN both_ways ON both_ways.a = r.reach),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c ON node = doc_id
"""

QUERIES = {"op8_near_dedup": op8_near_dedup}
ORACLES = {"op8_near_dedup": OP8_SQL}
