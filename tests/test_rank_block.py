"""The rank block against ranks taken pair by pair."""

import math
import random

import pandas as pd
import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyframe.operators import association
from tallyframe.operators.rank_block import distinct_records, pair_sums, presence_classes

KINDS = {"a": "continuous", "b": "ordinal", "c": "continuous", "d": "continuous", "g": "categorical", "h": "binary"}


def table(seed, n, gaps):
    """Columns with gaps of their own ('each'), of a skipped section that two columns share ('section'), or none."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        skipped = rng.random() < 0.3
        row = {"a": rng.gauss(1e6, 3), "b": rng.randint(1, 5), "c": rng.choice((0.0, -0.0, 1.5, 7.25)), "d": rng.random(), "g": rng.choice("xyzxx"), "h": rng.choice("01")}
        for name in row:
            if (gaps == "each" and rng.random() < 0.25) or (gaps == "section" and skipped and name in ("b", "g")):
                row[name] = None
        out.append(row)
    return out + out[: n // 3]


def frame_of(spark, data):
    return spark.createDataFrame([tuple(row[name] for name in KINDS) for row in data], "a double, b int, c double, d double, g string, h string").repartition(5)


def expected_rho(data, a, b):
    both = pd.DataFrame([(float(r[a]), float(r[b])) for r in data if r[a] is not None and r[b] is not None]).rank()
    return len(both), both[0].corr(both[1])


@pytest.mark.parametrize("gaps", ["none", "section", "each"])
def test_rho_of_every_pair(spark, gaps):
    data = table(3, 400, gaps)
    pairs = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("d", "b")]
    found = {(r["variable_a"], r["variable_b"]): r for r in rows(association.spearman_rho(frame_of(spark, data), pairs))}
    for a, b in pairs:
        n, rho = expected_rho(data, a, b)
        assert found[a, b]["n"] == n and math.isclose(found[a, b]["effect"], rho, abs_tol=1e-12)


@pytest.mark.parametrize("gaps", ["section", "each"])
def test_level_sums_equal_the_tests_pair_by_pair(spark, gaps):
    """rank_biserial, kruskal_wallis and eta count pair by pair; the matrix takes its values from the block."""
    df = frame_of(spark, table(5, 300, gaps))
    matrix = {(r["variable_a"], r["variable_b"]): r for r in rows(association.association_matrix(df, KINDS))}
    for r in rows(association.rank_biserial(df, [(x, "h") for x in "abcd"])):
        found = matrix[r["variable_a"], "h"]
        assert found["method"] == "rank_biserial" and found["n"] == r["n"] and found["min_group_n"] == r["min_group_n"]
        assert math.isclose(found["effect"], r["effect"], abs_tol=1e-12) and math.isclose(found["p_value"], r["p_value"], abs_tol=1e-12)
    for r in rows(association.eta(df, [(x, "g") for x in "abcd"])):
        found = matrix[r["variable_a"], "g"]
        assert found["method"] == "eta" and found["n"] == r["n"]
        assert math.isclose(found["effect"], r["eta"], rel_tol=1e-9) and math.isclose(found["p_value"], r["p_value"], rel_tol=1e-9)


def test_one_ranking_for_columns_with_the_same_gaps(spark):
    records = distinct_records(frame_of(spark, table(7, 200, "section")), ["a", "b", "c", "d"], ["g", "h"])
    classes = presence_classes(records, ["x0", "x1", "x2", "x3", "g0", "g1"])
    assert classes["x1"] == classes["g0"] != classes["x0"] == classes["x2"] == classes["x3"] == classes["g1"]
    assert records.agg(F.sum("weight")).first()[0] == 200 + 200 // 3 and records.count() == 200


def test_empty_constant_and_missing_columns(spark):
    schema = "a double, b double, g string"
    empty = spark.createDataFrame([], schema)
    assert rows(pair_sums(empty, {0: ("a", "b")}, {1: ("a", "g")})) == []
    assert [r["method"] for r in rows(association.association_matrix(empty, {"a": "continuous", "b": "continuous", "g": "categorical"}))] == ["not_computable"] * 3
    flat = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, None), (1.0, None, None), (float("nan"), 5.0, None)], schema)
    found = {r["pair"]: r for r in rows(association.association_matrix(flat, {"a": "continuous", "b": "continuous", "g": "categorical"}))}
    assert found[0]["n"] == 2 and found[0]["effect"] is None and found[1]["method"] == found[2]["method"] == "not_computable"


def test_more_levels_than_a_task_keeps(spark, monkeypatch):
    from tallyframe.operators import rank_block

    monkeypatch.setattr(rank_block, "LEVELS", 7)
    monkeypatch.setattr(rank_block, "CELLS", 50)
    df = spark.range(2000).select((F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 300).cast("string").alias("g"))
    found = rows(pair_sums(df, {}, {4: ("x", "g")}))
    assert len(found) == 300 and sum(r["n"] for r in found) == 2000 and abs(sum(r["s1"] for r in found)) < 1e-6


@pytest.mark.parametrize("gaps", ["none", "each"])
def test_numbers_with_many_values_by_either_way(spark, monkeypatch, gaps):
    """Ranks that are broadcast, joined number by number, or joined to a row for each number of a record are the same."""
    from tallyframe.operators import rank_block

    df = frame_of(spark, table(11, 300, gaps))
    numeric, mixed = {0: ("a", "b"), 1: ("a", "d"), 2: ("c", "d")}, {3: ("a", "g"), 4: ("c", "h")}

    def sums(few, joined):
        monkeypatch.setattr(rank_block, "BROADCAST_VALUES", few)
        monkeypatch.setattr(rank_block, "JOINED", joined)
        return {(r["pair"], r["level"]): [r[name] for name in rank_block.SUMS] for r in rows(pair_sums(df, numeric, mixed))}

    expected = sums(10_000, 4)
    for other in (sums(10, 4), sums(10, 0)):
        assert other.keys() == expected.keys()
        assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6) for key in expected for x, y in zip(expected[key], other[key]))


def test_the_table_is_read_once(spark, tmp_path):
    """Pairs of categories are counted from the records that the numbers are ranked on."""
    frame_of(spark, table(13, 100, "each")).write.parquet(str(tmp_path / "t"))
    matrix = association.association_matrix(spark.read.parquet(str(tmp_path / "t")), KINDS)
    assert str(tmp_path / "t") not in " ".join(matrix.inputFiles()) and rows(matrix)
