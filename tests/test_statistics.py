"""Statistics against published values, closed forms and small brute-force references."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyframe.functions import pvalues
from tallyframe.operators import association, clusters, crosstab, describe, effects, frequency, ranks, reliability, series, structure
from tallyframe.plans.analyze import analyze_dataset
from tallyframe.plans.policy import Policy


def test_frequency_denominator_and_suppression(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    policy = Policy(percent_denominator="all", suppress_below_n=2)
    a, b = rows(frequency.frequency_table(df, ["x"], policy), "value")
    assert (a["n"], a["percent"], a["missing_n"], a["denominator_n"]) == (2, 0.5, 1, 4)
    assert b["n"] is None and b["percent"] is None and b["suppressed"]
    shares = frequency.frequency_table(df, ["x"]).agg(F.sum("percent")).first()[0]
    assert shares == pytest.approx(1.0)


def test_frequency_of_empty_column_has_no_rows(spark):
    df = spark.createDataFrame([(None,), (None,)], "x string")
    assert rows(frequency.frequency_table(df, ["x"])) == []
    assert rows(frequency.frequency_report(df, ["x"])) == [{"field": "x", "value": "(missing)", "count": 2, "percent": 1.0}]


def test_combo_counts_toward_each_option_and_keeps_zero_rows(spark):
    df = spark.createDataFrame([("a+b",), ("a",), ("zz",), ("a+zz",), (None,)], "x string")
    found = {r["value"]: r for r in rows(frequency.frequency_coded(df, {"x": ["a", "b", "c"]}))}
    assert {v: r["n"] for v, r in found.items()} == {"a": 2, "b": 1, "c": 0, "zz": 1, "a+zz": 1}
    assert found["a"]["percent"] == pytest.approx(0.4) and found["a"]["has_overlap"]
    assert (found["a"]["valid_n"], found["a"]["missing_n"]) == (4, 1)


def test_crosstab_grid_keeps_zero_cells_and_counts_missing_in_group_size(spark):
    df = spark.createDataFrame([("g", "x"), ("g", None), ("h", "x")], "grp string, v string")
    found = {(r["group"], r["value"]): (r["n"], r["percent"]) for r in rows(crosstab.crosstab_grid(df, "v", "grp", ["x", "y"], ["g", "none"]))}
    assert found[("g", "x")] == (1, 0.5) and found[("g", "y")] == (0, 0.0)
    assert found[("none", "x")] == (0, 0.0)
    assert found[("__all__", "x")][0] == 2


def test_descriptives_edge_counts(spark):
    df = spark.createDataFrame([("5", None, 1.0), ("x", None, float("nan")), (None, None, 3.0)], "a string, b double, c double")
    found = {r["variable"]: r for r in rows(describe.descriptive_summary(df, ["a", "b", "c"]))}
    assert found["a"]["n"] == 1 and found["a"]["std"] is None and found["a"]["median"] == 5.0
    assert all(found["b"][name] is None for name in describe.SUMMARY_COLUMNS)
    assert found["c"]["n"] == 2 and found["c"]["q1"] == 1.5


def test_mode_is_smallest_of_most_frequent(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (1.0,), (1.0,), (2.0,)], "x double")
    assert rows(describe.descriptive_mode(df, ["x"]))[0]["mode"] == 1.0


@pytest.mark.parametrize("per_bucket", [1, 3, 50_000])
def test_ranks_and_quantiles_do_not_depend_on_buckets(spark, per_bucket):
    rng = random.Random(7)
    data = [("v" if i % 3 else "w", float(rng.choice([0, 0, 0, 1, 2, 3.5, rng.randint(4, 40)]))) for i in range(400)]
    df = spark.createDataFrame(data, "k string, x double")
    counts = df.groupBy("k", "x").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["k"], r["x"]): r["midrank"] for r in rows(ranks.midranks(counts, ["k"], "x", buckets=per_bucket))}
    frame = pd.DataFrame(data, columns=["k", "x"])
    frame["r"] = frame.groupby("k")["x"].rank()
    assert got == {(k, x): r for k, x, r in frame.drop_duplicates(["k", "x"]).itertuples(index=False)}
    q = rows(ranks.quantiles(counts, ["k"], "x", {"p": 0.37}, buckets=per_bucket, bound_keys=[]), "k")
    assert [r["p"] for r in q] == pytest.approx(list(frame.groupby("k")["x"].quantile(0.37)))


def test_many_buckets_are_searched_in_stretches(spark):
    values = [((i * 7919) % 3001) / 4 for i in range(3001)]
    counts = spark.createDataFrame([(x, 2) for x in values], "x double, n bigint")
    got = {r["x"]: (r["cum"], r["ties"], r["total"]) for r in rows(ranks.cumulative_counts(counts, [], "x", bound_keys=[], buckets=400))}
    assert got == {x: (2 * (i + 1), 2, 6002) for i, x in enumerate(sorted(values))}
    middle = ranks.quantiles(counts.withColumn("k", F.lit("a")), ["k"], "x", {"p": 0.5, "q": 1.0, "z": 0.0}, buckets=400)
    assert rows(middle)[0] == {"k": "a", "p": 375.0, "q": 750.0, "z": 0.0}


def test_hot_values_and_salted_rest_get_the_same_ranks(spark):
    data = [(0, 0.0, float(i)) for i in range(300)] + [(0, float(i), 0.5) for i in range(1, 300)]
    df = spark.createDataFrame(data, "pair int, a double, b double").withColumn("n", F.lit(1).cast("bigint"))
    totals = df.groupBy("pair", "a").agg(F.sum("n").alias("n"))
    joined = ranks.join_ranks(df, ranks.midranks(totals, ["pair"], "a"), totals, ["pair"], "a", spread="b")
    got = {r["a"]: r["midrank"] for r in rows(joined)}
    expected = pd.Series([d[1] for d in data]).rank()
    assert joined.count() == len(data)
    assert got == {d[1]: r for d, r in zip(data, expected)}


def test_scale_of_perfect_items_and_reasons(spark):
    df = spark.createDataFrame([(1, 1, 5), (2, 2, 5), (3, 3, 5)], "a int, b int, c int")
    found = {r["scale"]: r for r in rows(reliability.cronbach_alpha(df, {"ab": ["a", "b"], "c": ["c"], "cc": ["c", "c"], "z": ["a", "z"]}))}
    assert found["ab"]["alpha"] == pytest.approx(1.0) and found["ab"]["n"] == 3
    assert found["c"]["reason"] == "insufficient_data" and found["cc"]["reason"] == "zero_total_variance"
    assert found["z"]["reason"] == "missing_columns:z" and found["z"]["n"] == 0


def test_benjamini_hochberg_is_monotone_and_keeps_null(spark):
    df = spark.createDataFrame([(0, 0.01), (1, 0.04), (2, None), (3, 0.03)], "i int, p_value double")
    assert [r["adjusted_p_value"] for r in rows(association.benjamini_hochberg(df), "i")] == [pytest.approx(0.03), pytest.approx(0.04), None, pytest.approx(0.04)]


def test_benjamini_hochberg_against_brute_force(spark):
    rng = random.Random(3)
    p = [None if rng.random() < 0.2 else round(rng.random() ** 3, 2) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(p)), "i int, p_value double")
    known = sorted((v, i) for i, v in enumerate(p) if v is not None)
    expected, running = [None] * len(p), 1.0
    for rank in range(len(known), 0, -1):
        running = min(running, known[rank - 1][0] * len(known) / rank)
        expected[known[rank - 1][1]] = running
    got = [r["adjusted_p_value"] for r in rows(association.benjamini_hochberg(df), "i")]
    assert [g is None for g in got] == [e is None for e in expected]
    assert [g for g in got if g is not None] == pytest.approx([e for e in expected if e is not None])
    assert all(g >= v for g, v in zip(got, p) if v is not None)
    many = [r["adjusted_p_value"] for r in rows(association.benjamini_hochberg_many(df, "i"), "i")]
    assert [m is None for m in many] == [e is None for e in expected] and [m for m in many if m is not None] == pytest.approx([g for g in got if g is not None])


def test_running_minimum_does_not_depend_on_buckets(spark):
    rng = random.Random(11)
    data = [(k, float(x), rng.random(), 1) for k in "ab" for x in range(200)]
    df = spark.createDataFrame(data, "k string, x double, m double, n bigint")
    got = {(r["k"], r["x"]): r["m"] for r in rows(ranks.suffix_min(df, ["k"], "x", "m", buckets=40))}
    assert got == {(k, x): min(m for kk, xx, m, _ in data if kk == k and xx >= x) for k, x, _, _ in data}


@pytest.fixture(scope="module")
def mixed(spark):
    data = [(1, "a", 0, 1, 2), (2, "a", 0, 2, 3), (3, "a", 1, 3, 4), (8, "b", 1, 4, 5), (9, "b", 1, 5, 6), (10, "b", 1, 6, 7)]
    return spark.createDataFrame(data, "score int, segment string, flag int, item_1 int, item_2 int")


def test_mixed_frame_matrix(mixed):
    types = {"score": "continuous", "segment": "categorical", "flag": "binary"}
    found = {(r["variable_a"], r["variable_b"]): r for r in rows(association.association_matrix(mixed, types))}
    by_segment, by_flag, both = found[("score", "segment")], found[("score", "flag")], found[("segment", "flag")]
    assert (by_segment["method"], by_segment["effect"], by_segment["min_group_n"]) == ("rank_biserial", 1.0, 3)
    assert by_segment["p_value"] == pytest.approx(0.1) and by_flag["p_value"] == pytest.approx(2 / 15)
    assert both["method"] == "cramers_v" and both["effect"] == pytest.approx(math.sqrt(0.5))
    assert both["p_value"] == pytest.approx(0.083265, abs=1e-6) and both["min_group_n"] == 2
    assert all(r["caution"] == "low_pair_n" and r["significant"] is None for r in found.values())
    assert by_flag["direction"] == "same" and both["direction"] is None


def test_analyze_dataset_families(mixed):
    found = analyze_dataset(
        mixed, {"score": "continuous", "segment": "categorical", "flag": "binary"}, {"scale": ["item_1", "item_2"]}, [{"outcome": "score", "group": "segment"}]
    )
    assert rows(found["reliability"])[0]["alpha"] == pytest.approx(1.0)
    test = rows(found["group_tests"])[0]
    assert test["method"] == "mann_whitney_u" and test["statistic"] == 0.0 and test["caution"] == "small_group"
    assert [(g["group"], g["n"], g["median"]) for g in test["groups"]] == [("a", 3, 2.0), ("b", 3, 9.0)]


def test_refused_analyses(mixed):
    with pytest.raises(ValueError, match="score=interval"):
        association.association_matrix(mixed, {"score": "interval"})
    with pytest.raises(ValueError, match="missing: nope"):
        analyze_dataset(mixed, {"nope": "binary"})
    with pytest.raises(ValueError, match="comparison columns are missing"):
        association.compare_groups(mixed, [("score", "nope")])


def test_degenerate_pairs_give_null_with_reason(spark):
    df = spark.createDataFrame([(1.0, "x", None, 5.0), (2.0, "x", "y", 5.0), (3.0, "x", None, 5.0)], "v double, one string, gap string, flat double")
    types = {"v": "continuous", "one": "categorical", "gap": "categorical", "flat": "ordinal"}
    found = {(r["variable_a"], r["variable_b"]): r for r in rows(association.association_matrix(df, types))}
    assert found[("v", "gap")]["method"] == "not_computable" and found[("v", "gap")]["n"] == 1
    assert found[("v", "one")]["method"] == "eta" and found[("v", "one")]["effect"] is None
    assert found[("v", "flat")]["method"] == "spearman_rho" and found[("v", "flat")]["p_value"] is None
    assert all(r["adjusted_p_value"] is None for r in found.values())
    test = rows(association.compare_groups(df, [("v", "one")]))[0]
    assert (test["method"], test["caution"], test["statistic"]) == ("not_computable", "insufficient_groups", None)


def test_group_tests_against_brute_force(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"x": rng.integers(0, 9, 200).astype(float), "g": rng.choice(list("abc"), 200), "h": rng.choice(["p", "q"], 200)})
    df = spark.createDataFrame(frame)
    rank = frame["x"].rank()
    n = len(frame)
    ties = sum(c**3 - c for c in frame["x"].value_counts())
    h = 12 / (n * (n + 1)) * sum(len(r) * (r.mean() - (n + 1) / 2) ** 2 for _, r in rank.groupby(frame["g"])) / (1 - ties / (n**3 - n))
    kw = rows(association.kruskal_wallis(df, [("x", "g")]))[0]
    assert kw["h"] == pytest.approx(h) and kw["p_value"] == pytest.approx(math.exp(-h / 2))
    p = rank[frame["h"] == "p"]
    u = p.sum() - len(p) * (len(p) + 1) / 2
    mw = rows(association.mann_whitney(df, [("x", "h")]))[0]
    assert mw["u"] == u and mw["u"] + (mw["n1"] * mw["n2"] - u) == mw["n1"] * mw["n2"]
    sd = math.sqrt(mw["n1"] * mw["n2"] / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = (max(u, mw["n1"] * mw["n2"] - u) - mw["n1"] * mw["n2"] / 2 - 0.5) / sd
    assert mw["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)))


def test_chi_square_does_not_depend_on_labels_or_empty_cells(spark):
    cells = {("a", "x"): 7, ("a", "y"): 3, ("b", "x"): 2, ("c", "y"): 5}
    data = [(a, b) for (a, b), n in cells.items() for _ in range(n)]
    other = [({"a": "zz", "b": "q", "c": "a"}[a], b) for a, b in data]
    one = rows(association.chi_square(spark.createDataFrame(data, "u string, v string"), [("u", "v")]))[0]
    two = rows(association.chi_square(spark.createDataFrame(other, "u string, v string"), [("u", "v")]))[0]
    table = pd.crosstab(pd.Series([a for a, _ in data]), pd.Series([b for _, b in data])).to_numpy()
    expected = np.outer(table.sum(1), table.sum(0)) / table.sum()
    assert one["chi2"] == pytest.approx(((table - expected) ** 2 / expected).sum()) == two["chi2"]
    assert one["df"] == 2 and one["min_group_n"] == 2


def test_odds_ratio_correction_and_limits(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (0, 0, 3), (0, 1, 1)], "a int, b int, three int")
    found = {(r["variable_a"], r["variable_b"]): r for r in rows(effects.odds_ratio(df, [("a", "b"), ("a", "three")]))}
    corrected = found[("a", "b")]
    assert corrected["corrected"] and corrected["odds_ratio"] == pytest.approx(2.5 * 1.5 / (0.5 * 1.5))
    assert found[("a", "three")]["odds_ratio"] is None


def test_spearman_of_monotone_and_slope(spark):
    df = spark.createDataFrame([(float(i), float(i) ** 3, 2.0 * i + 1) for i in range(1, 8)], "x double, y double, z double")
    rho = rows(association.spearman_rho(df, [("x", "y")]))[0]
    assert rho["effect"] == pytest.approx(1.0) and rho["p_value"] == pytest.approx(0.0, abs=1e-12)
    fit = rows(effects.regression_slope(df, [("x", "z")]))[0]
    assert (fit["slope"], fit["intercept"]) == (pytest.approx(2.0), pytest.approx(1.0))


def test_result_does_not_depend_on_shuffle_partitions(spark, mixed):
    types = {"score": "continuous", "segment": "categorical", "flag": "binary", "item_1": "ordinal"}
    first = rows(association.association_matrix(mixed, types), "pair")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert rows(association.association_matrix(mixed, types), "pair") == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_tail_probabilities_match_tables():
    assert 2 * pvalues.normal_upper(1.959963985) == pytest.approx(0.05, rel=1e-8)
    for x, df, p in ((3.841458821, 1, 0.05), (5.991464547, 2, 0.05), (18.30703805, 10, 0.05), (135.8067, 100, 0.01)):
        assert pvalues.chi2_upper(x, df) == pytest.approx(p, rel=1e-5)
    for t, df, p in ((2.228138852, 10, 0.05), (12.7062047, 1, 0.05), (2.575829304, 1e7, 0.01)):
        assert pvalues.t_two_sided(t, df) == pytest.approx(p, rel=1e-5)
    for f, a, b, p in ((4.102821, 2, 10, 0.05), (3.020383, 2, 297 * 1000, None)):
        if p:
            assert pvalues.f_upper(f, a, b) == pytest.approx(p, rel=1e-5)
        assert pvalues.f_upper(f, a, b) == pytest.approx((1 + a * f / b) ** (-b / 2), rel=1e-8)


def test_exact_mann_whitney_against_enumeration():
    from itertools import combinations

    for n1, n2 in ((2, 4), (3, 5), (4, 4)):
        us = [sum(c) + n1 - n1 * (n1 + 1) // 2 for c in combinations(range(n1 + n2), n1)]
        for u in range(n1 * n2 + 1):
            top = max(u, n1 * n2 - u)
            assert pvalues.mann_whitney_exact(u, n1, n2) == pytest.approx(min(1.0, 2 * sum(v >= top for v in us) / len(us)))


def test_histogram_of_constant_column_and_top_edge(spark):
    df = spark.createDataFrame([(2.0, 0.0), (2.0, 12.0)], "flat double, wide double")
    found = rows(series.histogram(df, ["flat", "wide"]), "variable", "bin")
    flat = [r for r in found if r["variable"] == "flat"]
    assert sum(r["n"] for r in found) == 4 and (flat[0]["bin_low"], flat[-1]["bin_high"]) == (1.5, 2.5)
    assert [r["n"] for r in found if r["variable"] == "wide"] == [1] + [0] * 10 + [1]


def test_factors_of_two_blocks(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=300), rng.normal(size=300)
    data = [(float(x + e1), float(x + e2), float(y + e3), float(y + e4), 1.0) for x, y, (e1, e2, e3, e4) in zip(a, b, rng.normal(scale=0.3, size=(300, 4)))]
    df = spark.createDataFrame(data, "p double, q double, r double, s double, flat double")
    result = structure.factor_extraction(df, ["p", "q", "r", "s"])
    assert result.n_factors == 2 and not result.few_rows
    assert sorted(r["items"] for r in rows(structure.factor_grouping(result.loadings))) == [["p", "q"], ["r", "s"]]
    flat = {(r["item_a"], r["item_b"]): r["r"] for r in rows(structure.item_correlation(df, ["p", "flat"]))}
    assert flat[("p", "flat")] == 0.0 and flat[("flat", "flat")] == 1.0


def test_segments_find_separated_groups(spark):
    rng = np.random.default_rng(2)
    data = [(i, float(c * 20 + rng.normal()), float(c * -15 + rng.normal())) for i in range(90) for c in [i % 3]]
    df = spark.createDataFrame(data, "id int, u double, v double")
    found = structure.segment(df, "id", ["u", "v"], ks=(2, 3, 4), restarts=3)
    assert found.best_k == 3
    labels = {r["id"]: r["cluster"] for r in rows(found.assigned)}
    assert all(labels[i] == labels[i % 3] for i in range(90)) and len({labels[0], labels[1], labels[2]}) == 3
    flat = structure.pca_2d(df, "id", ["u", "v"])
    assert abs(flat.agg(F.avg("axis_1")).first()[0]) < 1e-9


def test_silhouettes_shuffle_by_parts_and_not_by_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(clusters, "SOURCES", 4)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(6000, 2)), 6)
    df = spark.createDataFrame(x.tolist(), "u double, v double")
    blocks = clusters.vector_blocks(df, ["u", "v"])
    models = {2: x[:2], 3: x[2:5]}
    n = blocks.count()
    assert n > 4 and clusters.distance_sums(blocks, 2, models).count() <= n * (n // 4 + 1) < n * n
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for k, score in clusters.silhouettes(blocks, 2, models).items():
        own = ((x[:, None] - models[k][None]) ** 2).sum(2).argmin(1)
        means = np.stack([apart[:, own == c].sum(1) / np.maximum((own == c).sum() - (own == c), 1) for c in range(k)], axis=1)
        inside = means[np.arange(len(x)), own]
        means[np.arange(len(x)), own] = np.inf
        outside = means.min(1)
        assert score == pytest.approx(((outside - inside) / np.maximum(inside, outside)).mean(), abs=1e-9)


def test_impute_uses_median_and_smallest_mode(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 0.0), (None, None), (8.0, None)], "idx double, ind double")
    got = rows(structure.impute_central(df, ["idx"], ["ind"]))
    assert got[2] == {"idx": 3.0, "ind": 0.0} and got[3]["ind"] == 0.0
