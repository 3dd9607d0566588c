"""Frequencies with explicit denominators, missing counts and small-cell suppression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.recode import combo_parts
from tallyframe.operators.common import kinds_of, lookup, require_columns, share, text, unpivot
from tallyframe.plans.policy import Policy
from tallyframe.sources.dimensions import small_table

MISSING_LEVEL = "(missing)"
OTHER_LEVEL = "(other)"


def suppress_small(df: DataFrame, policy: Policy, n: str = "n", percent: str = "percent") -> DataFrame:
    """Blank n and percent of cells with 0 < n < suppress_below_n."""
    small = (F.col(n) > 0) & (F.col(n) < policy.suppress_below_n)
    return df.withColumns({
        "suppressed": small,
        n: F.when(~small, F.col(n)),
        percent: F.when(~small, F.col(percent)),
    })


def _value_counts(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Counts per (variable, value) incl. NULL, and per-variable totals from those counts."""
    kinds = kinds_of(df)
    require_columns(df, columns, "frequency")
    counts = (
        unpivot(df, {name: text(kinds, name) for name in columns})
        .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("variable").agg(
        F.sum("n").alias("all_n"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("valid_n"),
    )
    return counts, totals


def _answered(counts: DataFrame, totals: DataFrame) -> DataFrame:
    # The second test never holds; needing both sides, the filter stays above the shuffle that counts
    # and totals share instead of making two different scans of them.
    joined = lookup(counts, totals, ["variable"])
    return joined.filter(F.col("value").isNotNull() | (F.col("n") > F.col("all_n")))


def frequency_table(df: DataFrame, columns: Sequence[str], policy: Policy | None = None) -> DataFrame:
    policy = policy or Policy()
    rows = _answered(*_value_counts(df, columns))
    denominator = F.col("all_n") if policy.percent_denominator == "all" else F.col("valid_n")
    table = rows.select(
        "variable", "value", "n",
        share(F.col("n"), denominator).alias("percent"),
        "valid_n",
        (F.col("all_n") - F.col("valid_n")).alias("missing_n"),
        denominator.alias("denominator_n"),
    )
    return suppress_small(table, policy)


def frequency_report(df: DataFrame, columns: Sequence[str] | None = None, id_column: str = "record_id") -> DataFrame:
    """Every column but the id, with missing as a level of its own and all rows as denominator."""
    columns = list(columns or [name for name in df.columns if name != id_column])
    counts, totals = _value_counts(df, columns)
    return lookup(counts, totals, ["variable"]).select(
        F.col("variable").alias("field"),
        F.coalesce("value", F.lit(MISSING_LEVEL)).alias("value"),
        F.col("n").alias("count"),
        share(F.col("n"), F.col("all_n")).alias("percent"),
    )


def options_frame(df: DataFrame, options: Mapping[str, Sequence[str]]) -> DataFrame:
    """Declared options as a dimension: (variable, value, position)."""
    rows = [(name, code, i) for name, codes in options.items() for i, code in enumerate(codes)]
    return small_table(df.sparkSession, rows, "variable string, value string, position int")


def _known(options: Mapping[str, Sequence[str]]) -> Column:
    """Per-variable array of known codes, as a literal."""
    known = F.lit(None).cast("array<string>")
    for name, codes in options.items():
        known = F.when(F.col("variable") == name, F.array(*[F.lit(code) for code in codes]).cast("array<string>")).otherwise(known)
    return F.coalesce(known, F.array().cast("array<string>"))


def split_combos(counts: DataFrame, options: Mapping[str, Sequence[str]], keys: Sequence[str] = ("variable",)) -> DataFrame:
    """Credit a combo to each of its options. Works on counts, so the blow-up is per distinct value."""
    return (
        counts.select(*keys, F.explode(combo_parts("value", _known(options))).alias("value"), "n")
        .groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    )


def frequency_coded(df: DataFrame, options: Mapping[str, Sequence[str]]) -> DataFrame:
    """Declared options first (kept when zero), then unexpected values; combos count toward each option.

    The percent denominator is all rows. has_overlap tells that the tallies exceed the answered rows.
    """
    counts, totals = _value_counts(df, list(options))
    tallies = split_combos(_answered(counts, totals), options)
    declared = options_frame(df, options)
    known = lookup(tallies, declared, ["variable", "value"], how="left")
    seen = known.groupBy("variable").agg(F.sum("n").alias("tallied"))
    zeros = lookup(declared, totals, ["variable"]).join(tallies, ["variable", "value"], "left_anti").select(
        "variable", "value", F.lit(0).cast("bigint").alias("n"), "position"
    )
    rows = known.select("variable", "value", "n", "position").unionByName(zeros)
    rows = lookup(lookup(rows, totals, ["variable"]), seen, ["variable"], how="left")
    return rows.select(
        "variable", "value", "n",
        share(F.col("n"), F.col("all_n")).alias("percent"),
        F.col("position").isNotNull().alias("declared"),
        "position", "valid_n",
        (F.col("all_n") - F.col("valid_n")).alias("missing_n"),
        F.col("all_n").alias("total_n"),
        (F.coalesce("tallied", F.lit(0)) > F.col("valid_n")).alias("has_overlap"),
    )


def frequency_combo(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """Combo-aware tallies of one column over the values that occur."""
    return frequency_coded(df, {column: known}).filter("n > 0").select(
        "variable", "value", "n", "percent", "valid_n", "missing_n", "has_overlap"
    )


def indicator_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """n of ticked rows and size per group for many 0/1 columns: one aggregation, then unpivot."""
    require_columns(df, [*columns, *by], "indicator")
    ticked = [F.count_if(F.col(name) == 1).alias(name) for name in columns]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_n"), *ticked)
    return wide.unpivot([*by, "total_n"], list(columns), "option", "n")


def multi_select_freq(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = indicator_counts(df, columns)
    return rows.select("option", "n", share(F.col("n"), F.col("total_n")).alias("percent"), "total_n").orderBy(
        F.col("n").desc(), "option"
    )


def grid_freq(df: DataFrame, columns: Sequence[str], extra_column: str) -> DataFrame:
    """A device grid's cells and its standalone option in one table."""
    flags = df.withColumn(extra_column, F.col(extra_column).cast("int"))
    return multi_select_freq(flags, [*columns, extra_column])


def multi_select_by_group(
    df: DataFrame, columns: Sequence[str], group: str, groups: Sequence[str] | None = None
) -> DataFrame:
    """Each option within each group; the denominator is the group's size. Rows without a group drop out."""
    df = df.filter(F.col(group).isin(*groups)) if groups is not None else df.filter(F.col(group).isNotNull())
    rows = indicator_counts(df, columns, [group])
    return rows.select(
        "option", F.col(group).alias("group"), "n", F.col("total_n").alias("n_group"),
        share(F.col("n"), F.col("total_n")).alias("percent"),
    )


def matrix_summary(df: DataFrame, rows: Mapping[str, str], options: Sequence[str]) -> DataFrame:
    """Matrix row x option: n and percent over all rows. rows maps a row code to its column.

    A combo counts toward each option; values outside the options gather in OTHER_LEVEL, which only
    appears when it is not empty.
    """
    wide = df.select(*[F.col(column).alias(code) for code, column in rows.items()])
    per_row = {code: list(options) for code in rows}
    counts, totals = _value_counts(wide, list(rows))
    tallies = split_combos(_answered(counts, totals), per_row)
    labelled = tallies.withColumn("value", F.when(F.col("value").isin(*options), F.col("value")).otherwise(OTHER_LEVEL))
    tallies = labelled.groupBy("variable", "value").agg(F.sum("n").alias("n"))
    grid = lookup(options_frame(df, {code: [*options, OTHER_LEVEL] for code in rows}), totals, ["variable"])
    filled = grid.join(tallies, ["variable", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # The grid is declared rows x options, so one window over all of it stays small.
    other_used = F.sum(F.when(F.col("value") == OTHER_LEVEL, F.col("n")).otherwise(0)).over(Window.partitionBy())
    return (
        filled.withColumn("_other", other_used)
        .filter((F.col("value") != OTHER_LEVEL) | (F.col("_other") > 0))
        .select(
            F.col("variable").alias("row"), F.col("value").alias("option"), "n",
            share(F.col("n"), F.col("all_n")).alias("percent"),
        )
    )


def frequency_union(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Stack frequency results; `part` keeps which table and in what order."""
    parts = [
        table.select(F.lit(i).alias("part_order"), F.lit(name).alias("part"), "value", "n", "percent")
        for i, (name, table) in enumerate(tables.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def indicator_lookup(frequency: DataFrame, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Pick named shares (name -> (variable, value)) out of a frequency result; absent ones give 0."""
    rows = [(name, variable, value) for name, (variable, value) in wanted.items()]
    names = small_table(frequency.sparkSession, rows, "indicator string, variable string, value string")
    return names.join(frequency.select("variable", "value", "percent"), ["variable", "value"], "left").select(
        "indicator", "variable", "value", F.coalesce("percent", F.lit(0.0)).alias("percent")
    )


def top_categories(frequency: DataFrame, k: int, by: Sequence[str] = ("variable",)) -> DataFrame:
    """The k largest non-empty levels of each variable, ties by value."""
    order = Window.partitionBy(*by).orderBy(F.col("n").desc(), "value")
    return frequency.filter("n > 0").withColumn("position", F.row_number().over(order)).filter(F.col("position") <= k)
