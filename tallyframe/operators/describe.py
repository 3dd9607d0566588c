"""Descriptives of numeric columns: moments in one pass, exact quartiles from ranked counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.common import kinds_of, lookup, number, require_columns, unpivot
from tallyframe.operators.ranks import quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
SUMMARY_COLUMNS = ("n", "mean", "std", "min", "q1", "median", "q3", "max")


def _value_counts(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    kinds = kinds_of(df)
    require_columns(df, columns, "descriptive")
    long = unpivot(df, {name: number(kinds, name) for name in columns}, value="x")
    counts = long.filter(F.col("x").isNotNull()).groupBy("variable", "x").agg(F.count(F.lit(1)).alias("n"))
    return long, counts


def _moments(long: DataFrame) -> DataFrame:
    """All variables stay, those without a number having only NULLs."""
    n = F.count("x")
    return long.groupBy("variable").agg(
        F.nullif(n, F.lit(0)).alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    ).withColumn("std", F.when(F.col("n") > 1, F.col("std")))


def descriptive_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    long, counts = _value_counts(df, columns)
    order = quantiles(counts, ["variable"], "x", QUARTILES)
    return lookup(_moments(long), order, ["variable"], how="left").select("variable", *SUMMARY_COLUMNS)


def descriptive_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The summary plus the mode, the smallest of the most frequent values."""
    _, counts = _value_counts(df, columns)
    # max over (count, -value): the highest count and, among equals, the smallest value.
    best = counts.groupBy("variable").agg(F.max(F.struct("n", (-F.col("x")).alias("x"))).alias("_best"))
    mode = best.select("variable", (-F.col("_best.x")).alias("mode"))
    return lookup(descriptive_summary(df, columns), mode, ["variable"], how="left")


def group_mean_index(df: DataFrame, index: str, group: str) -> DataFrame:
    return df.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias("group")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(index).alias("mean")
    )


def index_describe(df: DataFrame, index: str) -> DataFrame:
    return descriptive_summary(df, [index]).select("variable", "min", "median", "max", "mean")
