"""Helpers shared by the statistics: long form, keyed joins, rounding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.recode import to_numeric


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} columns are missing: {', '.join(missing)}")


def kinds_of(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def text(kinds: Mapping[str, str], column: str) -> Column:
    """The column as level text; NaN counts as missing."""
    if kinds[column] in ("double", "float"):
        return F.when(~F.isnan(F.col(column)), F.col(column).cast("string"))
    return F.col(column).cast("string")


def number(kinds: Mapping[str, str], column: str) -> Column:
    """The column as double; what is no number, and NaN, is missing."""
    kind = kinds[column]
    if kind in ("double", "float", "string"):
        return to_numeric(column)
    return F.col(column).cast("int").cast("double") if kind == "boolean" else F.col(column).cast("double")


def unpivot(df: DataFrame, cells: Mapping[str, Column], keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """One row per record and variable: (keep..., variable, value)."""
    kept = [F.col(name) for name in keep]
    wide = df.select(*kept, *[cell.alias(name) for name, cell in cells.items()])
    return wide.unpivot(kept, list(cells), "variable", value)


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], bounded: bool = True, how: str = "inner") -> DataFrame:
    """Join on keys. bounded says the right side has a row count fixed by the declared columns, so it is
    broadcast; otherwise the join strategy is left to the size Spark measures at run time."""
    return left.join(F.broadcast(right) if bounded else right, list(keys), how)


def spread_join(large: DataFrame, small: DataFrame, keys: Sequence[str], by: str, salts: int = 32) -> DataFrame:
    """Join on keys of which one may hold most of the large side: its rows scatter over salts by a hash of `by`, and
    the small side, one row a key, is there once for each salt."""
    salted = large.withColumn("_salt", F.pmod(F.hash(by), F.lit(salts)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def share(n: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, n / denominator)
