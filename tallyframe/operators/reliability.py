"""Scale reliability and the composite index it licenses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.recode import combo_has
from tallyframe.operators.common import kinds_of, number
from tallyframe.sources.dimensions import small_table

ALPHA_THRESHOLD = 0.7


def _added(columns: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left + right, columns)


def _scale_aggregates(prefix: str, items: Sequence[Column], complete: Column) -> list[Column]:
    kept = [F.when(complete, item) for item in items]
    variances = [F.coalesce(F.var_samp(item), F.lit(0.0)) for item in kept]
    return [
        F.count_if(complete).alias(f"{prefix}_n"),
        _added(variances).alias(f"{prefix}_items"),
        F.var_samp(F.when(complete, _added(items))).alias(f"{prefix}_total"),
    ]


def _alpha_rows(wide: DataFrame, scales: Sequence[tuple[str, str, int]]) -> DataFrame:
    cells = []
    for prefix, name, k in scales:
        n, items, total = (F.col(f"{prefix}_{part}") for part in ("n", "items", "total"))
        enough = (n >= 2) & F.lit(k >= 2)
        varied = F.coalesce(total > 0, F.lit(False))
        alpha = F.lit(k / (k - 1) if k > 1 else 0.0) * (1 - items / F.when(total > 0, total))
        cells.append(F.struct(
            F.lit(name).alias("scale"), F.when(enough & varied, alpha).alias("alpha"),
            n.alias("n"), F.lit(k).alias("items"),
            F.when(~enough, "insufficient_data").when(~varied, "zero_total_variance").alias("reason"),
        ))
    return wide.select(F.inline(F.array(*cells)))


def cronbach_alpha(df: DataFrame, scales: Mapping[str, Sequence[str]]) -> DataFrame:
    """Alpha of every scale over its complete cases, all scales in one pass."""
    kinds = kinds_of(df)
    present, absent = [], []
    aggregates: list[Column] = []
    for i, (name, columns) in enumerate(scales.items()):
        missing = sorted(set(columns) - set(df.columns))
        if missing:
            absent.append((name, len(columns), f"missing_columns:{','.join(missing)}"))
            continue
        items = [number(kinds, column) for column in columns]
        complete = reduce(lambda left, right: left & right, [item.isNotNull() for item in items], F.lit(True))
        if len(items) > 0:
            aggregates += _scale_aggregates(f"_{i}", items, complete)
            present.append((f"_{i}", name, len(items)))
    parts = []
    if present:
        parts.append(_alpha_rows(df.agg(*aggregates), present))
    if absent:
        parts.append(small_table(df.sparkSession, absent, "scale string, items int, reason string").select(
            "scale", F.lit(None).cast("double").alias("alpha"), F.lit(0).cast("bigint").alias("n"), "items", "reason"
        ))
    return reduce(DataFrame.unionByName, parts)


def positive_items(columns: Sequence[str], positive_codes: Sequence[str]) -> dict[str, Column]:
    """1 when the answer, or a member of its combo, is a positive code; not answered counts as 0."""
    return {
        name: combo_has(F.col(name).cast("string"), positive_codes, null_as=False).cast("int") for name in columns
    }


def binary_item_matrix(df: DataFrame, columns: Sequence[str], positive_codes: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[item.alias(name) for name, item in positive_items(columns, positive_codes).items()])


def cronbach_alpha_filled(df: DataFrame, scales: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """Alpha of coded scales, name -> (columns, positive codes), on the filled 0/1 items."""
    aggregates, listed = [], []
    for i, (name, (columns, codes)) in enumerate(scales.items()):
        items = [item.cast("double") for item in positive_items(columns, codes).values()]
        aggregates += _scale_aggregates(f"_{i}", items, F.lit(True))
        listed.append((f"_{i}", name, len(items)))
    return _alpha_rows(df.agg(*aggregates), listed)


def index_value(columns: Sequence[str], positive_codes: Sequence[str]) -> Column:
    """Share of items answered positively, 0 to 100."""
    items = list(positive_items(columns, positive_codes).values())
    return _added([item.cast("double") for item in items]) / F.lit(float(len(items))) * 100


def composite_index(
    df: DataFrame, scales: Mapping[str, tuple[Sequence[str], Sequence[str]]], keep: Sequence[str], threshold: float = ALPHA_THRESHOLD
) -> DataFrame:
    """One index column per scale, NULL throughout when the scale's alpha is below the threshold."""
    gate = cronbach_alpha_filled(df, scales)
    return df.select(
        *keep,
        *[
            F.when(gate.filter(F.col("scale") == name).select("alpha").scalar() >= threshold, index_value(columns, codes)).alias(name)
            for name, (columns, codes) in scales.items()
        ],
    )
