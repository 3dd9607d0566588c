"""Directed effect sizes: odds ratio, eta squared, regression slope."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.pvalues import correlation_p
from tallyframe.operators.association import Pair, _complete_pairs, _counts, _named, eta
from tallyframe.operators.common import require_columns
from tallyframe.sources.dimensions import small_table

EFFECT_KINDS = ("odds_ratio", "eta_squared", "slope")


def odds_ratio(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """2x2 odds ratio with levels in text order; 0.5 is added to every cell when one is empty.
    NULL below four complete rows or unless both sides have two levels."""
    indexed = dict(enumerate(pairs))
    counts = _counts(_complete_pairs(df, indexed, "text", "text"))
    edges = counts.groupBy("pair").agg(
        F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1"), F.sum("n").alias("total")
    )
    cells = counts.join(F.broadcast(edges), "pair")

    def cell(a: str, b: str):
        return F.coalesce(F.sum(F.when((F.col("a") == F.col(a)) & (F.col("b") == F.col(b)), F.col("n"))), F.lit(0)).cast("double")

    table = cells.groupBy("pair", "total", "a0", "a1", "b0", "b1").agg(
        cell("a1", "b1").alias("n11"), cell("a1", "b0").alias("n10"), cell("a0", "b1").alias("n01"), cell("a0", "b0").alias("n00")
    )
    corrected = F.least("n11", "n10", "n01", "n00") == 0
    shift = F.when(corrected, 0.5).otherwise(0.0)
    # Two levels a side means the four corner cells hold every row.
    four = F.col("n11") + F.col("n10") + F.col("n01") + F.col("n00")
    usable = (F.col("total") >= 4) & (F.col("a0") != F.col("a1")) & (F.col("b0") != F.col("b1")) & (four == F.col("total"))
    ratio = (F.col("n11") + shift) * (F.col("n00") + shift) / ((F.col("n10") + shift) * (F.col("n01") + shift))
    return _named(table, indexed).select(
        "variable_a", "variable_b", F.when(usable, ratio).alias("odds_ratio"), F.col("total").alias("n"),
        *[F.when(usable, F.col(name) + shift).alias(name) for name in ("n11", "n10", "n01", "n00")],
        (corrected & usable).alias("corrected"),
    )


def eta_squared(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Pairs in either order; the side declared numeric by its type is taken as the outcome."""
    kinds = dict(df.dtypes)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    ordered = [(a, b) if kinds[a] in numeric and kinds[b] not in numeric else (b, a) for a, b in pairs]
    return eta(df, ordered, p_method="anova").select(
        F.col("variable_b").alias("category"), F.col("variable_a").alias("outcome"),
        F.when(F.col("n") >= 3, F.col("eta_squared")).alias("eta_squared"), "p_value", "n",
    )


def regression_slope(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Least squares of the second variable on the first; NULL below three rows or with a constant x."""
    require_columns(df, {name for pair in pairs for name in pair}, "regression")
    indexed = dict(enumerate(pairs))
    rows = _complete_pairs(df, indexed, "number", "number")
    fit = rows.groupBy("pair").agg(
        F.count(F.lit(1)).alias("n"), F.min("a").alias("_low"), F.max("a").alias("_high"),
        F.regr_slope("b", "a").alias("slope"), F.regr_intercept("b", "a").alias("intercept"),
        F.corr("a", "b").alias("r"),
    )
    usable = (F.col("n") >= 3) & (F.col("_low") < F.col("_high"))
    fit = fit.withColumn("r", F.when(F.isnan("r"), None).otherwise(F.col("r")))
    return _named(fit, indexed).select(
        "variable_a", "variable_b", F.when(usable, F.col("slope")).alias("slope"),
        F.when(usable, F.col("intercept")).alias("intercept"), F.when(usable, F.col("r")).alias("r"),
        F.when(usable, correlation_p("r", "n")).alias("p_value"), "n",
    )


def curated_effects(df: DataFrame, pairs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Declared (topic, a, b, kind) effects: (topic, a, b, kind, value, n, detail). One plan per kind."""
    unknown = sorted({kind for *_, kind in pairs} - set(EFFECT_KINDS))
    if unknown:
        raise ValueError(f"unsupported effect kinds: {', '.join(unknown)}")
    asked = small_table(
        df.sparkSession, [(i, *pair) for i, pair in enumerate(pairs)], "position int, topic string, a string, b string, kind string"
    )

    def wanted(kind: str) -> list[Pair]:
        return list(dict.fromkeys((a, b) for _, a, b, k in pairs if k == kind))

    def detail(*names: str):
        return F.create_map(*[part for name in names for part in (F.lit(name), F.col(name).cast("double"))])

    parts = []
    if wanted("odds_ratio"):
        parts.append(odds_ratio(df, wanted("odds_ratio")).select(
            F.col("variable_a").alias("a"), F.col("variable_b").alias("b"), F.lit("odds_ratio").alias("kind"),
            F.col("odds_ratio").alias("value"), "n", detail("n11", "n10", "n01", "n00").alias("detail"),
        ))
    if wanted("slope"):
        parts.append(regression_slope(df, wanted("slope")).select(
            F.col("variable_a").alias("a"), F.col("variable_b").alias("b"), F.lit("slope").alias("kind"),
            F.col("slope").alias("value"), "n", detail("intercept", "r", "p_value").alias("detail"),
        ))
    if wanted("eta_squared"):
        table = eta_squared(df, wanted("eta_squared"))
        for a, b in (("category", "outcome"), ("outcome", "category")):
            parts.append(table.select(
                F.col(a).alias("a"), F.col(b).alias("b"), F.lit("eta_squared").alias("kind"),
                F.col("eta_squared").alias("value"), "n", detail("p_value").alias("detail"),
            ))
    results = reduce(DataFrame.unionByName, parts)
    return asked.join(results, ["a", "b", "kind"], "left").select("position", "topic", "a", "b", "kind", "value", "n", "detail")
