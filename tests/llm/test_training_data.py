"""Resampling and fill-in-middle against plain Python, on the odd cases and on empty tables."""

import random
import re
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import fill_middle, resample

ODD = [
    (2, "a\nb\nc\nd e\n\n\nf g h\n"), (5, "\n\n"), (8, "One two\nthree FOUR\nfive"), (11, "w" * 200 + " " + "é" * 90 + "\n" + "x" * 70), (14, "same line\n" * 400),
    (17, "same line\nother line\r\nsame line"), (20, " ".join(f"t{k}" for k in range(20))), (23, " ".join(f"t{k}" for k in range(19))),
]


def table_of(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, "clash", 7, "clash", 1.0, 2) for d, t in rows], "doc_id long, text string, key string, n long, line string, weight double, rank int").repartition(parts)


def by_id(df, *columns):
    return {row.doc_id: tuple(row[c] for c in columns) for row in df.collect()}


def test_crc_of_long_and_short_words():
    rng = random.Random(3)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 2, 7, 63, 64, 65, 300, 5, 64)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    first = np.array([zlib.crc32(b"head" * k) for k in range(len(texts))], np.uint32)
    got = resample.crc_extend(first, data, ends - [len(t) for t in texts], ends)
    assert got.tolist() == [zlib.crc32(b"head" * k + t) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def many(rows_):
    rng = random.Random(11)
    lines = [" ".join(rng.choice(("the", "of", "stone", "river", "light", "house")) for _ in range(rng.randint(1, 12))) for _ in range(30)]
    return rows_ + ODD + [(1000 + k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for k in range(200)]


def test_resample_equals_brute_force(spark, many):
    target = ["the river of light\nstone house", None, "", "river river"]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.drawn(resample.importance_weights(table_of(spark, many), wanted))
    assert by_id(got, "n_features", "weight", "score", "rank") == brute.resampled(many, target)
    chosen = resample.resample(table_of(spark, many), wanted)
    assert chosen.columns == ["doc_id", "text", "key", "n", "line", "weight", "rank"]
    assert {row.doc_id for row in chosen.collect()} == {d for d, (*_, rank) in brute.resampled(many, target).items() if rank}


def test_resample_repeated_and_missing_ids(spark):
    """Rows of one id, null too, are one document with the features of all its rows."""
    words = " ".join(f"t{k}" for k in range(15))
    rows = [(1, words), (1, words), (None, words), (None, "x\ny"), (3, None)]
    got = by_id(resample.drawn(resample.importance_weights(table_of(spark, rows), table_of(spark, [(1, words)])), percent=100), "n_words", "n_features", "rank")
    assert got[1][:2] == (30, 84) and got[None][:2] == (17, 45) and got[3] == (0, 0, None) and got[1][2] == 1


def test_resample_ties_go_to_the_smaller_id(spark):
    rows = spark.createDataFrame([(k, 25, 0) for k in range(60)], "doc_id long, n_words long, weight long")
    same = resample.drawn(rows.withColumn("weight", F.lit(0)), percent=50).select("doc_id", "score", "rank").collect()
    ranked = sorted((r.rank, -r.score, r.doc_id) for r in same if r.rank)
    assert [r for r, _, _ in ranked] == list(range(1, 31))
    assert [(s, d) for _, s, d in ranked] == sorted((s, d) for _, s, d in ranked)


def test_resample_empty_tables(spark):
    none = table_of(spark, [], 1)
    assert resample.drawn(resample.importance_weights(none, none)).count() == 0
    got = by_id(resample.importance_weights(table_of(spark, [(1, "a b"), (2, "")]), none), "n_features", "weight")
    assert got[1][0] == 3 and got[2] == (0, 0)


def test_fill_middle_equals_brute_force(spark, rows_):
    marked = [(3001, "a <P> b"), (3002, "a < P> <S"), (3003, "<M>"), (3004, "x" * 100_000 + "é"), (3005, "éé\n日本 <P"), (None, "no id here"), (None, "no id here"), (3005, "éé\n日本 <P")]
    rows = rows_ + ODD + marked + [(k, f"text {k} of\nsome wörds, and 😀 more") for k in range(4000, 4200)]
    df = table_of(spark, rows)
    out = fill_middle.fill_in_middle(df)
    got = sorted((repr(r.doc_id), (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in out.collect())
    assert got == sorted((repr(d), brute.turned(d, t)) for d, t in rows)
    assert {form for _, (_, form, *_) in got} == {"plain", "psm", "spm"}
    back = out.select("doc_id", fill_middle.restore("output", "form").alias("text")).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(d), t or "") for d, t in rows)


@pytest.mark.parametrize("unit, pattern", [("line", "[^\n]*\n|[^\n]+"), ("char", ".")])
def test_fill_middle_other_units(spark, rows_, unit, pattern):
    got = by_id(fill_middle.fill_in_middle(table_of(spark, rows_), unit=unit), "n", "form", "prefix_chars", "middle_chars", "output")
    assert got == {d: brute.turned(d, t, re.compile(pattern, re.S)) for d, t in rows_}


def test_fill_middle_empty_table_and_other_markers(spark):
    assert fill_middle.fill_in_middle(table_of(spark, [], 1)).count() == 0
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    out = fill_middle.fill_in_middle(table_of(spark, [(k, f"some <P> text {k}") for k in range(50)]), rate=100, spm=50, markers=marks)
    back = out.select("doc_id", "form", fill_middle.restore("output", "form", marks).alias("text")).collect()
    assert {r.form for r in back} == {"psm", "spm"} and all(r.text == f"some <P> text {r.doc_id}" for r in back)


def test_wavelet_ranks():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 8, 1000).astype(np.uint8)
    matrix = fill_middle.WaveletMatrix(codes)
    at = np.array([0, 1, 63, 64, 65, 500, 1000])
    for code in range(8):
        assert matrix.rank(code, at).tolist() == [int((codes[:k] == code).sum()) for k in at]
