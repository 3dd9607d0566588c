"""Sinks: safe records, wide tables, result families. One dataset each, written by Spark's committers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_safe_records(records: DataFrame, path: str) -> None:
    """Privacy-safe documents as JSON lines."""
    records.select(F.to_json("document").alias("value")).write.mode("overwrite").text(path)


def write_wide(wide: DataFrame, path: str, csv: bool = False) -> None:
    """Wide table as Parquet, or as CSV with a header."""
    if csv:
        wide.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', encoding="UTF-8")
    else:
        wide.write.mode("overwrite").parquet(path)


def write_results(results: Mapping[str, DataFrame], path: str, format: str = "parquet") -> None:
    """One dataset per result family below path."""
    for family, table in results.items():
        table.write.mode("overwrite").format(format).save(f"{path.rstrip('/')}/{family}")
