"""The Jaccard join against all pairs, on clusters of changed copies, odd cases and empty tables."""

import random

import brute
import numpy as np
import pytest
from corpus_cases import prose
from pyspark.sql import functions as F

from tallyframe.llm import token_groups


def changed(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def clustered():
    """Changed copies of three texts, of which one is not there itself; texts that share a long passage; short texts;
    texts that grow word by word, whose sizes cross the borders of classes."""
    rng = random.Random(8)
    bases = [prose(rng, n, [f"w{k}" for k in range(400)]) for n in (150, 60, 25)]
    texts = [changed(rng, base, rng.randint(1 if base is bases[0] else 0, 7)) for base in bases for _ in range(120)]
    passage = prose(rng, 40, [f"p{k}" for k in range(60)])
    texts += [f"{prose(rng, rng.randint(2, 40), ('some', 'other', 'words', 'here'))} {passage} end {k % 7}" for k in range(60)]
    texts += [" ".join(f"g{k}" for k in range(n)) for n in range(1, 90)]
    texts += [prose(rng, rng.randint(1, 14), ("red", "blue", "green")) for _ in range(100)]
    return [(2 * k + 5, text) for k, text in enumerate(rng.sample(texts, len(texts)))]


def groups_of(spark, rows, words, percent, parts=4):
    df = spark.createDataFrame([(d, t, 1, 2, 3, "x") for d, t in rows], "doc_id long, text string, node long, n long, group long, parts string").repartition(parts)
    return token_groups.jaccard_groups(df, words, percent)


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 60)])
def test_equals_all_pairs(spark, clustered, rows_, words, percent):
    rows = clustered + [(d + 100_000, t) for d, t in rows_]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in groups_of(spark, rows, words, percent).collect()}
    wanted = {d: found[:2] for d, found in brute.near(rows, words, percent).items()}
    assert got == wanted
    assert len({c for _, c in got.values()}) < len(rows) - 150


def test_opened_groups_find_links_across_groups(spark, clustered):
    """Each link between nodes of different groups is in a group that one of the two opens."""
    sets = {d: sorted(brute.shingles(t, 3)) for d, t in clustered if brute.shingles(t, 3)}
    numbers = {x: k for k, x in enumerate(sorted({x for s in sets.values() for x in s}))}
    sets = {d: {numbers[x] for x in s} for d, s in sets.items()}
    group = {d: min(sets) if k % 3 == 0 else d for k, d in enumerate(sets)}
    node_rows = [(d, len(s), group[d]) for d, s in sets.items()]
    grouped = spark.createDataFrame(node_rows, "node long, n long, group long")
    table = spark.createDataFrame([(d, sorted(s)) for d, s in sets.items()], "node long, shingles array<long>")
    opened = {(r.node, r.group) for r in token_groups.opened_groups(grouped, table, 90).collect()}
    assert all(group[d] < g for d, g in opened)
    for a in sets:
        for b in sets:
            if group[a] < group[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                assert (a, group[b]) in opened


def test_signatures_have_an_equal_part():
    rng = np.random.default_rng(5)
    for percent in (60, 80, 90, 95):
        for _ in range(150):
            n = int(rng.integers(1, 400))
            a = rng.integers(1, 1 << 62, n).astype(np.uint64)
            lost = int(rng.integers(0, n // 4 + 1))
            b = np.unique(np.concatenate((a[lost:], rng.integers(1, 1 << 62, int(rng.integers(0, n // 4 + 1))).astype(np.uint64))))
            a = np.unique(a)
            shared = len(np.intersect1d(a, b))
            if shared == 0 or 100 * shared < percent * (len(a) + len(b) - shared) or shared == len(a) == len(b):
                continue
            found, ends = token_groups.part_signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), percent)
            assert len(np.intersect1d(found[: ends[1]], found[ends[1] :]))


def test_repeated_and_missing_ids(spark):
    long = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    rows = [(9, long), (4, long + " more"), (4, other), (7, other + " more"), (None, long), (None, None), (7, other + " more"), (2, ""), (2, None)]
    got = sorted((repr(r.doc_id), r.n_shingles, r.component_id) for r in groups_of(spark, rows, 3, 90).collect())
    assert got == sorted([("9", 58, 4), ("4", 59, 4), ("4", 58, 4), ("7", 59, 4), ("7", 59, 4), ("None", 58, None), ("None", 0, None), ("2", 0, 2), ("2", 0, 2)])


def test_empty_table_and_nothing_linked(spark):
    assert groups_of(spark, [], 3, 90, 1).count() == 0
    rows = [(k, prose(random.Random(k), 20, [f"u{k}-{j}" for j in range(30)])) for k in range(5)]
    assert all(r.component_id == r.doc_id for r in groups_of(spark, rows, 3, 90).collect())


def test_hot_join_keeps_every_row(spark):
    large = spark.range(5000).select(F.when(F.col("id") < 4000, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    sizes = large.groupBy("k").agg(F.count(F.lit(1)).alias("size"))
    assert token_groups.hot_join(large, small, ["k"], sizes, "id").where("v = 2 * k").count() == 5000
