"""Facades: a configured analysis, the record-to-result run, and bundles of declared indicators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.association import association_matrix, compare_groups, validate_kinds
from tallyframe.operators.describe import descriptive_summary
from tallyframe.operators.flatten import flatten_records, manifest_join, manifest_orphans
from tallyframe.operators.frequency import frequency_report, frequency_table
from tallyframe.operators.privacy import pii_projection
from tallyframe.operators.quality import contract_lint, validate_records
from tallyframe.operators.reliability import cronbach_alpha
from tallyframe.plans.policy import COUNTED_KINDS, NUMERIC_KINDS, Policy
from tallyframe.sources.contract import Contract
from tallyframe.sources.dimensions import small_table
from tallyframe.sources.records import load_manifest, scan_records, valid_records
from tallyframe.sources.sinks import write_results, write_safe_records, write_wide


def analyze_dataset(
    df: DataFrame,
    variable_types: Mapping[str, str],
    scales: Mapping[str, Sequence[str]] | None = None,
    comparisons: Sequence[tuple[str, str] | Mapping[str, str]] | None = None,
    policy: Policy | None = None,
) -> dict[str, DataFrame]:
    """All configured result families. df is read column-pruned by each; persist it or pass a written
    Parquet table when computing it is expensive."""
    policy = policy or Policy()
    validate_kinds(df, variable_types)
    counted = [name for name, kind in variable_types.items() if kind in COUNTED_KINDS]
    numeric = [name for name, kind in variable_types.items() if kind in NUMERIC_KINDS]
    pairs = [(c["outcome"], c["group"]) if isinstance(c, Mapping) else tuple(c) for c in comparisons or []]
    results = {
        "policy": small_table(df.sparkSession, list(policy.settings().items()), "setting string, value string"),
        "associations": association_matrix(df, variable_types, policy),
    }
    if counted:
        results["frequencies"] = frequency_table(df, counted, policy)
    if numeric:
        results["descriptives"] = descriptive_summary(df, numeric)
    if scales:
        results["reliability"] = cronbach_alpha(df, scales)
    if pairs:
        results["group_tests"] = compare_groups(df, pairs, policy)
    return results


def report_tables(wide: DataFrame, analysis: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of a report: data, frequencies with the missing level, and the analysis families."""
    tables = {"data": wide, "frequencies": frequency_report(wide)}
    names = {"descriptives": "descriptives", "associations": "associations", "reliability": "reliability", "policy": "methodology"}
    tables |= {title: analysis[family] for family, title in names.items() if family in analysis}
    if "group_tests" in analysis:
        tables["group_tests"] = analysis["group_tests"].withColumn("groups", F.to_json("groups"))
    return tables


def require_clean(findings: DataFrame, what: str) -> None:
    first = findings.first()
    if first is not None:
        raise ValueError(f"{what}: {first.asDict()}")


def run_analysis(
    spark: SparkSession,
    contract_path: str,
    manifest_path: str,
    records_path: str,
    output: str,
    settings: Mapping[str, object] | None = None,
    one_per_line: bool = False,
) -> DataFrame:
    """Records to safe records, wide table and results below output. Returns the wide table as written.

    The written Parquet is the cut in the lineage: analysis reads it back instead of parsing again.
    """
    settings = dict(settings or {})
    contract = Contract.load(spark, contract_path)
    lint = spark.read.text(contract_path, wholetext=True).select(
        F.lit(contract_path).alias("contract"), F.try_parse_json("value").alias("document")
    )
    require_clean(contract_lint(lint), "contract")
    manifest = load_manifest(spark, manifest_path)
    scanned = scan_records(spark, records_path, one_per_line)
    records = valid_records(scanned)
    require_clean(manifest_orphans(records, manifest), "records missing from the manifest")
    write_safe_records(pii_projection(records, contract), f"{output}/safe_records")
    wide = manifest_join(flatten_records(records, contract), manifest, settings.get("include_manifest_columns", True))
    write_wide(wide, f"{output}/wide")
    write_results({"findings": validate_records(scanned, contract)}, output)
    saved = spark.read.parquet(f"{output}/wide")
    if settings.get("variable_types"):
        analysis = analyze_dataset(
            saved, settings["variable_types"], settings.get("scales"), settings.get("comparisons"),
            Policy(**dict(settings.get("policy") or {})),
        )
        write_results(analysis, f"{output}/analysis")
    return saved


def indicator_bundle(df: DataFrame, parts: Mapping[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Declared indicators stacked as (part, level, name, n, total_n, percent).

    Each part maps df to a result with some of: group/row/level, value/option/name, n, percent.
    """
    def column(table: DataFrame, names: Sequence[str], kind: str):
        found = next((name for name in names if name in table.columns), None)
        return (F.col(found) if found else F.lit(None)).cast(kind)

    stacked = None
    for name, build in parts.items():
        table = build(df)
        rows = table.select(
            F.lit(name).alias("part"),
            column(table, ("group", "row", "level", "region", "pair", "device"), "string").alias("level"),
            column(table, ("value", "option", "name", "side", "person", "scale", "variable"), "string").alias("name"),
            column(table, ("n",), "bigint").alias("n"),
            column(table, ("total_n", "n_group", "denominator_n", "valid_n"), "bigint").alias("total_n"),
            column(table, ("percent", "mean", "alpha"), "double").alias("value"),
        )
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked
