"""Type-aware association of variable pairs, and the rank tests they share.

Pairs are planned from the declared kinds on the driver. In the matrix, pairs with a number come from a block of
ranks that is multiplied with itself (rank_block). Pairs of categories, and the single rank tests, expand each record
into its complete pairs and collapse them again by a map-side partial count. Either way the number of shuffles
does not depend on the number of variables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.pvalues import chi2_p, correlation_p, f_p, mann_whitney_p
from tallyframe.functions.recode import base_question
from tallyframe.operators.common import kinds_of, lookup, number, require_columns, spread_join, text
from tallyframe.operators.rank_block import block_columns, category_counts, correlation, distinct_records, pair_sums
from tallyframe.operators.ranks import cumulative_counts, join_ranks, midranks, quantiles, suffix_min
from tallyframe.plans.policy import NUMERIC_KINDS, VARIABLE_KINDS, Policy
from tallyframe.sources.dimensions import small_table

Pair = tuple[str, str]
RESULT = "pair int, method string, effect double, p_value double, n bigint, min_group_n bigint"
SIGNED_METHODS = ("spearman_rho", "rank_biserial")


# ---- pair expansion -------------------------------------------------------------------------------

def _complete_pairs(df: DataFrame, pairs: Mapping[int, Pair], first: str, second: str) -> DataFrame:
    """(pair, a, b) for every record and pair with both present. first/second: 'text' or 'number'."""
    cells, kinds = {"text": text, "number": number}, kinds_of(df)
    left = list(dict.fromkeys(a for a, _ in pairs.values()))
    right = list(dict.fromkeys(b for _, b in pairs.values()))
    plan = F.array(*[
        F.struct(F.lit(i).alias("pair"), F.lit(left.index(a) + 1).alias("i"), F.lit(right.index(b) + 1).alias("j"))
        for i, (a, b) in pairs.items()
    ])
    packed = df.select(
        F.array(*[cells[first](kinds, name) for name in left]).alias("_left"),
        F.array(*[cells[second](kinds, name) for name in right]).alias("_right"),
    )
    spread = packed.select("_left", "_right", F.explode(plan).alias("p"))
    return spread.select(
        F.col("p.pair").alias("pair"),
        F.element_at("_left", F.col("p.i")).alias("a"), F.element_at("_right", F.col("p.j")).alias("b"),
    ).filter(F.col("a").isNotNull() & F.col("b").isNotNull())


def _counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("pair", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def contingency(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Pairwise-complete counts in long form: (variable_a, variable_b, a, b, n)."""
    require_columns(df, {name for pair in pairs for name in pair}, "contingency")
    indexed = dict(enumerate(pairs))
    return _named(_counts(_complete_pairs(df, indexed, "text", "text")), indexed).select(
        "variable_a", "variable_b", "a", "b", "n"
    )


def _named(rows: DataFrame, pairs: Mapping[int, Pair]) -> DataFrame:
    keys = list(pairs)
    position = F.array_position(F.array(*[F.lit(key) for key in keys]), F.col("pair")).cast("int")
    names = [F.array(*[F.lit(pairs[key][side]) for key in keys]) for side in (0, 1)]
    return rows.withColumns({"variable_a": F.element_at(names[0], position), "variable_b": F.element_at(names[1], position)})


# ---- category x category --------------------------------------------------------------------------

def _chi_square(counts: DataFrame) -> DataFrame:
    """(pair, chi2, df, n, n_rows, n_cols, min_group_n). Cells that never occur contribute their
    expected count, which is the total less the expected counts of the observed cells."""
    row = counts.groupBy("pair", "a").agg(F.sum("n").alias("row_n"))
    col = counts.groupBy("pair", "b").agg(F.sum("n").alias("col_n"))
    size = row.groupBy("pair").agg(F.sum("row_n").alias("total"))
    cells = spread_join(spread_join(counts, row, ["pair", "a"], by="b"), col, ["pair", "b"], by="a")
    cells = lookup(cells, size, ["pair"])
    expected = F.col("row_n").cast("double") * F.col("col_n") / F.col("total")
    gap = F.col("n") - expected
    # A row's cells add up to it, so the shares n / row_n of all cells add up to the number of rows.
    sums = cells.groupBy("pair", "total").agg(
        F.sum(gap * gap / expected).alias("_seen"), F.sum(expected).alias("_expected"),
        F.round(F.sum(F.col("n") / F.col("row_n"))).cast("bigint").alias("n_rows"),
        F.round(F.sum(F.col("n") / F.col("col_n"))).cast("bigint").alias("n_cols"),
        F.least(F.min("row_n"), F.min("col_n")).alias("min_group_n"),
    )
    return sums.select(
        "pair",
        (F.col("_seen") + F.greatest(F.col("total") - F.col("_expected"), F.lit(0.0))).alias("chi2"),
        ((F.col("n_rows") - 1) * (F.col("n_cols") - 1)).alias("df"),
        F.col("total").alias("n"), "n_rows", "n_cols", "min_group_n",
    )


def chi_square(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Pearson chi-square without continuity correction; NULL when a side has a single level."""
    indexed = dict(enumerate(pairs))
    table = _chi_square(_counts(_complete_pairs(df, indexed, "text", "text")))
    usable = F.col("df") > 0
    return _named(table, indexed).select(
        "variable_a", "variable_b", F.when(usable, F.col("chi2")).alias("chi2"), "df",
        F.when(usable, chi2_p("chi2", "df")).alias("p_value"), "n",
        F.when(usable, F.col("min_group_n")).alias("min_group_n"),
    )


def _cramers(counts: DataFrame) -> DataFrame:
    table = _chi_square(counts)
    usable = F.col("df") > 0
    v = F.sqrt(F.col("chi2") / (F.col("n") * (F.least("n_rows", "n_cols") - 1)))
    return table.select(
        "pair", F.lit("cramers_v").alias("method"), F.when(usable, F.least(v, F.lit(1.0))).alias("effect"),
        F.when(usable, chi2_p("chi2", "df")).alias("p_value"), "n",
        F.when(usable, F.col("min_group_n")).alias("min_group_n"),
    )


def cramers_v(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    indexed = dict(enumerate(pairs))
    return _named(_cramers(_counts(_complete_pairs(df, indexed, "text", "text"))), indexed).drop("pair")


# ---- number x number ------------------------------------------------------------------------------

def average_rank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Midrank of each distinct value of each column: (variable, x, n, midrank)."""
    from tallyframe.operators.describe import _value_counts

    _, counts = _value_counts(df, columns)
    return midranks(counts, ["variable"], "x").select("variable", "x", "n", "midrank")


def spearman_rho(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """rho of (number, number) pairs over the records that have both. Each number is ranked once for each set of gaps its
    partners have; the records are written to the checkpoint folder first (see pair_sums)."""
    indexed = dict(enumerate(pairs))
    return _named(_from_sums(pair_sums(df, indexed, {})), indexed).drop("pair", "min_group_n")


# ---- number x category ----------------------------------------------------------------------------

def _group_ranks(df: DataFrame, pairs: Mapping[int, Pair], min_level_n: int = 1) -> DataFrame:
    """pairs are (number, category); one row per pair that has complete rows:
    (pair, total, levels, min_group_n, tie_sum, h, u, n1, n2)."""
    counts = _counts(_complete_pairs(df, pairs, "number", "text"))
    if min_level_n > 1:
        level_n = counts.groupBy("pair", "b").agg(F.sum("n").alias("_level_n"))
        counts = counts.join(level_n.filter(F.col("_level_n") >= min_level_n), ["pair", "b"]).drop("_level_n")
    # Ranks come straight from the (value, level) counts: a value's rows are as many as its levels.
    ranked = midranks(counts, ["pair"], "a")
    centred_rank = F.col("midrank") - (F.col("total") + 1) / F.lit(2.0)
    ties = F.col("ties").cast("double")
    return _rank_summary(ranked.groupBy("pair", "b").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * centred_rank).alias("_rank_gap"),
        F.sum(F.col("n") * (ties * ties - 1)).alias("_ties"),
    ))


def _rank_summary(levels: DataFrame, *more: Column) -> DataFrame:
    """One row per pair from its levels (pair, b, n, _rank_gap, _ties); more: further aggregates of the levels to keep."""
    # The first level in text order is the least of (level, n, rank gap); no sort of the levels is needed.
    per_pair = levels.groupBy("pair").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("levels"), F.min("n").alias("min_group_n"), F.sum("_ties").alias("tie_sum"),
        F.sum(F.col("_rank_gap") * F.col("_rank_gap") / F.col("n")).alias("_rank_between"),
        F.min(F.struct("b", "n", "_rank_gap")).alias("_first"), *more,
    )
    kept = [name for name in per_pair.columns if not name.startswith("_") and name not in ("pair", "total", "levels", "min_group_n", "tie_sum")]
    total = F.col("total").cast("double")
    tie_correction = 1 - F.col("tie_sum") / (total * total * total - total)
    n1 = F.col("_first.n")
    n2 = F.col("total") - n1
    return per_pair.select(
        "pair", "total", "levels", "min_group_n", "tie_sum",
        F.when(
            (F.col("total") > 1) & (tie_correction > 1e-15),
            F.lit(12.0) / (total * (total + 1)) * F.col("_rank_between") / tie_correction,
        ).alias("h"),
        # R1 - n1(n1+1)/2 with R1 = rank gap + n1(N+1)/2, which leaves rank gap + n1*n2/2.
        F.when(F.col("levels") == 2, F.col("_first._rank_gap") + n1 * n2 / F.lit(2.0)).alias("u"),
        n1.alias("n1"), n2.alias("n2"), *kept,
    )


def _group_moments(df: DataFrame, pairs: Mapping[int, Pair]) -> DataFrame:
    """(pair, total, levels, min_group_n, between, ss_total) from per-level means and variances, which
    are combined before the shuffle."""
    levels = _complete_pairs(df, pairs, "number", "text").groupBy("pair", "b").agg(
        F.count(F.lit(1)).alias("n"), F.avg("a").alias("mean"), F.var_pop("a").alias("variance")
    )
    grand = levels.groupBy("pair").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand_mean"))
    gap = F.col("mean") - F.col("grand_mean")
    between = F.sum(F.col("n") * gap * gap)
    return lookup(levels, grand, ["pair"]).groupBy("pair").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("levels"), F.min("n").alias("min_group_n"),
        between.alias("between"), (between + F.sum(F.col("n") * F.col("variance"))).alias("ss_total"),
    )


def _eta_ratio() -> Column:
    usable = (F.col("ss_total") > 0) & (F.col("levels") > 1)
    return F.when(usable, F.least(F.sqrt(F.col("between") / F.col("ss_total")), F.lit(1.0)))


def _eta_p(p_method: str) -> Column:
    if p_method == "kruskal":
        return chi2_p("h", F.col("levels") - 1)
    return f_p(_f_ratio(), F.col("levels") - 1, F.col("total") - F.col("levels"))


def _u_p_value() -> Column:
    return mann_whitney_p("u", "n1", "n2", "tie_sum")


def _from_sums(sums: DataFrame, p_method: str = "kruskal") -> DataFrame:
    """Result rows of pairs with a number from their sums (pair_sums): rho for pairs of numbers, whose only row has no
    level, rank-biserial or eta for a number and a category."""
    levels = sums.select("pair", F.col("level").alias("b"), "n", *[F.col(name).alias(new) for name, new in (("s1", "_rank_gap"), ("s2", "_x"), ("s3", "_xx"), ("s4", "_ties"))])
    middle = F.sum("_x") * F.sum("_x") / F.sum("n")
    summary = _rank_summary(
        levels, (F.sum(F.col("_x") * F.col("_x") / F.col("n")) - middle).alias("between"), (F.sum("_xx") - middle).alias("ss_total"),
        F.count("b").alias("named"), F.max("_rank_gap").alias("s1"), F.max("_x").alias("s2"), F.max("_xx").alias("s3"),
    )
    numeric, two = F.col("named") == 0, F.col("levels") == 2
    biserial = 1 - 2 * F.col("u") / (F.col("n1").cast("double") * F.col("n2"))
    rho = F.when(numeric, correlation())
    return summary.select(
        "pair", F.when(numeric, "spearman_rho").when(two, "rank_biserial").otherwise("eta").alias("method"),
        F.when(numeric, rho).when(two, biserial).otherwise(_eta_ratio()).alias("effect"),
        F.when(numeric, correlation_p(rho, F.col("total"))).when(two, _u_p_value()).when(F.col("levels") > 2, _eta_p(p_method)).alias("p_value"),
        F.col("total").alias("n"), F.when(~numeric, F.col("min_group_n")).alias("min_group_n"),
    )


def _f_ratio() -> Column:
    within = F.col("ss_total") - F.col("between")
    freedom = (F.col("total") - F.col("levels")).cast("double")
    return F.when(
        (F.col("levels") > 1) & (freedom > 0) & (within > 0),
        F.col("between") / (F.col("levels") - 1) / (within / freedom),
    )


def rank_biserial(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """(number, two-level category) pairs; positive when the second level in text order is larger."""
    indexed = dict(enumerate(pairs))
    biserial = 1 - 2 * F.col("u") / (F.col("n1").cast("double") * F.col("n2"))
    return _named(_group_ranks(df, indexed).filter("levels = 2"), indexed).select(
        "variable_a", "variable_b", F.lit("rank_biserial").alias("method"), biserial.alias("effect"),
        _u_p_value().alias("p_value"), F.col("total").alias("n"), "min_group_n",
    )


def eta(df: DataFrame, pairs: Sequence[Pair], p_method: str = "kruskal") -> DataFrame:
    """Correlation ratio of (number, category) pairs, whatever the number of levels above one.
    p from Kruskal-Wallis, or from one-way ANOVA with p_method='anova'."""
    indexed = dict(enumerate(pairs))
    summary = _group_moments(df, indexed)
    if p_method == "kruskal":
        summary = lookup(summary, _group_ranks(df, indexed).select("pair", "h"), ["pair"])
    ratio = _eta_ratio()
    return _named(summary, indexed).select(
        "variable_a", "variable_b", ratio.alias("eta"), (ratio * ratio).alias("eta_squared"),
        _eta_p(p_method).alias("p_value"), F.col("total").alias("n"), "levels", "min_group_n",
    )


def anova_f(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    indexed = dict(enumerate(pairs))
    summary = _group_moments(df, indexed)
    df1, df2 = F.col("levels") - 1, F.col("total") - F.col("levels")
    return _named(summary, indexed).select(
        "variable_a", "variable_b", _f_ratio().alias("f"), df1.alias("df1"), df2.alias("df2"),
        f_p(_f_ratio(), df1, df2).alias("p_value"), F.col("total").alias("n"),
    )


def mann_whitney(df: DataFrame, comparisons: Sequence[Pair]) -> DataFrame:
    """U of the first level, two-sided p. NULL unless there are exactly two levels."""
    indexed = dict(enumerate(comparisons))
    summary = _group_ranks(df, indexed)
    return _named(summary, indexed).select(
        F.col("variable_a").alias("outcome"), F.col("variable_b").alias("group"), "u",
        F.when(F.col("levels") == 2, _u_p_value()).alias("p_value"), "n1", "n2", "levels",
    )


def kruskal_wallis(df: DataFrame, comparisons: Sequence[Pair], min_level_n: int = 1) -> DataFrame:
    """H with tie correction. min_level_n leaves out levels with fewer rows."""
    indexed = dict(enumerate(comparisons))
    summary = _group_ranks(df, indexed, min_level_n)
    freedom = F.col("levels") - 1
    return _named(summary, indexed).select(
        F.col("variable_a").alias("outcome"), F.col("variable_b").alias("group"),
        F.when(freedom > 0, F.col("h")).alias("h"), freedom.alias("df"),
        F.when(freedom > 0, chi2_p("h", freedom)).alias("p_value"), F.col("total").alias("n"),
    )


def group_medians(df: DataFrame, comparisons: Sequence[Pair]) -> DataFrame:
    """(outcome, group, level, n, median) for every level of every comparison."""
    indexed = dict(enumerate(comparisons))
    counts = _counts(_complete_pairs(df, indexed, "number", "text"))
    return _named(_level_medians(counts), indexed).select(
        F.col("variable_a").alias("outcome"), F.col("variable_b").alias("group"), "level", "n", "median"
    )


def _level_medians(counts: DataFrame) -> DataFrame:
    sizes = counts.groupBy("pair", "b").agg(F.sum("n").alias("n"))
    middle = quantiles(counts, ["pair", "b"], "a", {"median": 0.5}, bound_keys=["pair"])
    return sizes.join(middle, ["pair", "b"]).withColumnRenamed("b", "level")


def compare_groups(df: DataFrame, comparisons: Sequence[Pair], policy: Policy | None = None) -> DataFrame:
    """Mann-Whitney for two groups, Kruskal-Wallis for more, a reason otherwise.

    One row per comparison with the groups as array<struct<group,n,median>>; the number of groups is
    the number of levels of a declared grouping column.
    """
    policy = policy or Policy()
    require_columns(df, {name for pair in comparisons for name in pair}, "comparison")
    indexed = dict(enumerate(comparisons))
    counts = _counts(_complete_pairs(df, indexed, "number", "text"))
    summary = _group_ranks(df, indexed)
    details = _level_medians(counts).groupBy("pair").agg(
        F.array_sort(F.collect_list(F.struct(F.col("level").alias("group"), "n", "median"))).alias("groups")
    )
    asked = small_table(df.sparkSession, [(i, a, b) for i, (a, b) in indexed.items()], "pair int, outcome string, group string")
    rows = asked.join(summary, "pair", "left").join(details, "pair", "left")
    levels = F.coalesce("levels", F.lit(0))
    method = F.when(levels == 2, "mann_whitney_u").when(levels > 2, "kruskal_wallis").otherwise("not_computable")
    return rows.select(
        "outcome", "group", method.alias("method"),
        F.when(levels == 2, F.col("u")).when(levels > 2, F.col("h")).alias("statistic"),
        F.when(levels == 2, _u_p_value()).when(levels > 2, chi2_p("h", F.col("levels") - 1)).alias("p_value"),
        F.coalesce("groups", F.array().cast("array<struct<group:string,n:bigint,median:double>>")).alias("groups"),
        F.when(levels < 2, "insufficient_groups").when(F.col("min_group_n") < policy.min_group_n, "small_group").alias("caution"),
    )


def curated_group_tests(df: DataFrame, tests: Sequence[tuple[str, str, str, str]], low_n: int = 10) -> DataFrame:
    """Declared (topic, outcome, group, test) comparisons with groups below low_n rows marked.
    Mann-Whitney needs two groups of two or more; Kruskal-Wallis leaves out single-row groups."""
    pairs = {i: (outcome, group) for i, (_, outcome, group, _) in enumerate(tests)}
    every = _group_ranks(df, pairs)
    larger = _group_ranks(df, pairs, min_level_n=2)
    asked = small_table(
        df.sparkSession, [(i, *test) for i, test in enumerate(tests)], "pair int, topic string, outcome string, group string, test string"
    )
    u_side = every.select("pair", "u", "n1", "n2", "tie_sum", "levels", F.col("min_group_n").alias("smallest"))
    h_side = larger.select("pair", "h", F.col("levels").alias("kept_levels"))
    rows = asked.join(u_side, "pair", "left").join(h_side, "pair", "left")
    is_u = (F.col("test") == "mann_whitney") & (F.col("levels") == 2) & (F.col("smallest") >= 2)
    is_h = (F.col("test") == "kruskal_wallis") & (F.col("kept_levels") >= 2)
    return rows.select(
        "topic", "outcome", "group", "test",
        F.when(is_u, F.col("u")).when(is_h, F.col("h")).alias("statistic"),
        F.when(is_u, _u_p_value()).when(is_h, chi2_p("h", F.col("kept_levels") - 1)).alias("p_value"),
        (~(is_u | is_h) | (F.col("smallest") < low_n) | F.col("levels").isNull()).alias("low_n"),
    )


# ---- the matrix -----------------------------------------------------------------------------------

def validate_kinds(df: DataFrame, variable_types: Mapping[str, str]) -> None:
    unknown = sorted(f"{name}={kind}" for name, kind in variable_types.items() if kind not in VARIABLE_KINDS)
    if unknown:
        raise ValueError(f"unsupported variable kinds: {', '.join(unknown)}")
    require_columns(df, list(variable_types), "analysis")


def caution_flag(n: Column, min_group_n: Column, policy: Policy) -> Column:
    return F.when(n < policy.min_pair_n, "low_pair_n").when(min_group_n < policy.min_group_n, "small_group")


def significance_label(p_value: Column, low_n: Column, alpha: float) -> Column:
    """true / false, or NULL when p is unknown or the sample too small to tell."""
    return F.when(~low_n & p_value.isNotNull(), p_value < alpha)


def benjamini_hochberg(df: DataFrame, p: str = "p_value", out: str = "adjusted_p_value", family: Sequence[str] = ()) -> DataFrame:
    """Adjusted p within each family; NULL p stays NULL and does not count.

    Runs over test results. Equal p share the largest rank among them, which gives every member of a
    tie the same adjusted value as any ordering of the tie would.
    """
    by = [F.col(name) for name in family]
    known = F.col(p).isNotNull()
    rank = F.count(p).over(Window.partitionBy(*by).orderBy(F.col(p).asc_nulls_last()).rangeBetween(Window.unboundedPreceding, 0))
    total = F.count(p).over(Window.partitionBy(*by))
    ranked = df.withColumn("_scaled", F.when(known, F.col(p) * total / rank))
    from_largest = Window.partitionBy(*by).orderBy(F.col(p).desc_nulls_first()).rangeBetween(Window.unboundedPreceding, 0)
    adjusted = F.least(F.lit(1.0), F.min("_scaled").over(from_largest))
    return ranked.withColumn(out, F.when(known, adjusted)).drop("_scaled")


def benjamini_hochberg_many(df: DataFrame, id_column: str, p: str = "p_value", out: str = "adjusted_p_value", family: Sequence[str] = ()) -> DataFrame:
    """The same adjustment for families of any size, such as one test per record.

    Ranks and the running minimum are taken over the distinct p of a family in buckets; the result
    goes back to the rows with the frequent p broadcast. id_column tells rows of equal p apart.
    """
    keys = list(family) or ["_family"]
    rows = df if family else df.withColumn("_family", F.lit(0))
    counts = rows.filter(F.col(p).isNotNull()).groupBy(*keys, p).agg(F.count(F.lit(1)).alias("n"))
    ranked = cumulative_counts(counts, keys, p, bound_keys=[])
    scaled = ranked.withColumn("midrank", F.least(F.lit(1.0), F.col(p) * F.col("total") / F.col("cum")))
    adjusted = suffix_min(scaled, keys, p, "midrank")
    joined = join_ranks(rows, adjusted, counts, keys, p, spread=id_column).withColumnRenamed("midrank", out)
    return joined if family else joined.drop("_family")


def association_dispatch(variable_types: Mapping[str, str]) -> dict[str, dict[int, Pair]]:
    """Plan every i<j pair by declared kind. Number x category pairs are ordered (number, category)."""
    plan: dict[str, dict[int, Pair]] = {"numeric": {}, "category": {}, "mixed": {}}
    for i, (a, b) in enumerate(combinations(variable_types, 2)):
        numeric = [variable_types[name] in NUMERIC_KINDS for name in (a, b)]
        if all(numeric):
            plan["numeric"][i] = (a, b)
        elif not any(numeric):
            plan["category"][i] = (a, b)
        else:
            plan["mixed"][i] = (a, b) if numeric[0] else (b, a)
    return plan


def association_matrix(df: DataFrame, variable_types: Mapping[str, str], policy: Policy | None = None, p_method: str = "kruskal") -> DataFrame:
    """One row per variable pair. Result rows number V(V-1)/2 for V declared variables.

    Pairs with a number come from one block of ranks (pair_sums, which writes the distinct records to the checkpoint folder
    first); pairs of categories from their counts, taken from the same records, which collapse before they are shuffled."""
    policy = policy or Policy()
    validate_kinds(df, variable_types)
    plan = association_dispatch(variable_types)
    spark = df.sparkSession
    numeric, mixed, category = plan["numeric"], plan["mixed"], plan["category"]
    parts = []
    if numeric or mixed:
        # With a number there, every category is part of a mixed pair, so these records have all of them.
        numbers, categories = block_columns(numeric, mixed)
        records = distinct_records(df, numbers, categories)
        parts.append(_from_sums(pair_sums(df, numeric, mixed, records), p_method))
        counts = category_counts(records, category, categories) if category else None
    else:
        counts = _counts(_complete_pairs(df, category, "text", "text")) if category else None
    if category:
        parts.append(_cramers(counts))
    pairs = small_table(
        spark, [(i, a, b) for i, (a, b) in enumerate(combinations(variable_types, 2))],
        "pair int, variable_a string, variable_b string",
    )
    found = reduce(DataFrame.unionByName, parts) if parts else small_table(spark, [], RESULT)
    rows = pairs.join(found, "pair", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    computable = F.col("n") >= 2
    rows = rows.withColumns({
        "method": F.when(computable, F.col("method")).otherwise("not_computable"),
        "effect": F.when(computable, F.col("effect")), "p_value": F.when(computable, F.col("p_value")),
        "min_group_n": F.when(computable, F.col("min_group_n")),
    })
    adjusted = (
        benjamini_hochberg(rows) if policy.multiple_testing == "benjamini-hochberg"
        else rows.withColumn("adjusted_p_value", F.col("p_value"))
    )
    caution = caution_flag(F.col("n"), F.col("min_group_n"), policy)
    return adjusted.withColumn("caution", caution).select(
        "pair", "variable_a", "variable_b", "method", "effect", "p_value", "adjusted_p_value", "n", "min_group_n", "caution",
        significance_label(F.col("p_value"), F.col("caution").isNotNull(), policy.alpha).alias("significant"),
        effect_direction(F.col("method"), F.col("effect")).alias("direction"),
    )


def effect_direction(method: Column, effect: Column) -> Column:
    """'same' or 'opposite' for signed methods, NULL for measures that only have a strength."""
    return F.when(
        method.isin(*SIGNED_METHODS) & effect.isNotNull(), F.when(effect > 0, "same").otherwise("opposite")
    )


def top_associations(
    matrix: DataFrame, k: int = 20, structural: Sequence[str] = (), overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """The k strongest reliable pairs, without pairs of one question or of two structural columns."""
    a, b = F.col("variable_a"), F.col("variable_b")
    kept = matrix.filter(F.col("effect").isNotNull() & F.col("caution").isNull()).filter(
        base_question(a, overrides) != base_question(b, overrides)
    )
    if structural:
        kept = kept.filter(~(a.isin(*structural) & b.isin(*structural)))
    return kept.withColumn("strength", F.abs("effect")).orderBy(F.col("strength").desc(), "pair").limit(k)


def _mirrored(matrix: DataFrame) -> DataFrame:
    one = matrix.select("variable_a", "variable_b", "effect")
    two = matrix.select(F.col("variable_b").alias("variable_a"), F.col("variable_a").alias("variable_b"), "effect")
    return one.unionByName(two)


def block_summary(matrix: DataFrame, sections: Mapping[str, str]) -> DataFrame:
    """Mean absolute effect between sections (section_a, section_b, n_pairs, mean_effect)."""
    dimension = small_table(matrix.sparkSession, list(sections.items()), "variable string, section string")
    left = dimension.select(F.col("variable").alias("variable_a"), F.col("section").alias("section_a"))
    right = dimension.select(F.col("variable").alias("variable_b"), F.col("section").alias("section_b"))
    both = lookup(lookup(_mirrored(matrix), left, ["variable_a"]), right, ["variable_b"])
    return both.groupBy("section_a", "section_b").agg(
        F.count("effect").alias("n_pairs"), F.avg(F.abs("effect")).alias("mean_effect")
    )


def effect_matrix(matrix: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Symmetric table of effects with an empty diagonal, one column per variable."""
    both = _mirrored(matrix)
    return both.groupBy(F.col("variable_a").alias("variable")).pivot("variable_b", list(variables)).agg(F.first("effect"))
