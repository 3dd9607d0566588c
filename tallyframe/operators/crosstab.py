"""Cross-tabulations: pairwise-complete, fixed grids, nested regions, overlapping groups, shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.recode import any_of_indicators, combo_has, combo_split
from tallyframe.operators.common import kinds_of, require_columns, share, spread_join, text
from tallyframe.operators.frequency import suppress_small
from tallyframe.plans.policy import Policy
from tallyframe.sources.dimensions import small_table

ALL_GROUPS = "__all__"


def crosstab(df: DataFrame, outcome: str, group: str, policy: Policy | None = None) -> DataFrame:
    """Outcome within group over rows where both are present.

    Rows lacking either value are gone before any count, so missing_n is 0 and the denominators
    `all` and `valid` agree.
    """
    kinds = kinds_of(df)
    policy = policy or Policy()
    require_columns(df, [outcome, group], "cross-tab")
    cells = (
        df.select(text(kinds, group).alias("group"), text(kinds, outcome).alias("value")).dropna()
        .groupBy("group", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    sizes = cells.groupBy("group").agg(F.sum("n").alias("valid_n"))
    table = spread_join(cells, sizes, ["group"], by="value").select(
        "group", "value", "n",
        share(F.col("n"), F.col("valid_n")).alias("percent"),
        "valid_n", F.lit(0).cast("bigint").alias("missing_n"), F.col("valid_n").alias("denominator_n"),
    )
    return suppress_small(table, policy)


def _grid_cells(df: DataFrame, outcome: str, groups: Mapping[str, str]) -> DataFrame:
    """Counts per (level, group, value) for each grouping column and for all rows, in one pass."""
    kinds = kinds_of(df)
    columns = [text(kinds, column).alias(f"_g{i}") for i, column in enumerate(groups.values())]
    base = df.select(text(kinds, outcome).alias("value"), *columns)
    keys = [F.col(f"_g{i}") for i in range(len(groups))]
    sets = [[key, F.col("value")] for key in keys] + [[F.col("value")]]
    cells = base.groupingSets(sets, *keys, F.col("value")).agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("n")
    )
    # grouping_id has one bit per key, highest first; a cleared bit is the key in use.
    width = len(groups)
    level, group = F.lit("all"), F.lit(ALL_GROUPS)
    for i, name in enumerate(groups):
        used = F.expr(f"(_gid & {1 << (width - i)}) = 0")
        level = F.when(used, F.lit(name)).otherwise(level)
        group = F.when(used, F.col(f"_g{i}")).otherwise(group)
    return cells.select(level.alias("level"), group.alias("group"), "value", "n").filter(F.col("group").isNotNull())


def crosstab_levels(
    df: DataFrame,
    outcome: str,
    groups: Mapping[str, str],
    options: Sequence[str],
    declared_groups: Mapping[str, Sequence[str]] | None = None,
    withhold: Sequence[str] = (),
) -> DataFrame:
    """Options x groups at several levels plus all rows, zero cells kept.

    The denominator is the size of the group including rows that did not answer. Groups are the
    declared ones, or those present in the data. percent is withheld for the listed groups.
    """
    cells = _grid_cells(df, outcome, groups)
    sizes = cells.groupBy("level", "group").agg(
        F.sum("n").alias("total_n"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("valid_n"),
    )
    if declared_groups:
        wanted = small_table(
            df.sparkSession, [("all", ALL_GROUPS)] + [(level, group) for level, names in declared_groups.items() for group in names],
            "level string, group string",
        )
        sizes = wanted.join(sizes, ["level", "group"], "left").na.fill(0, ["total_n", "valid_n"])
    slots = sizes.select(
        "*", F.posexplode(F.array(*[F.lit(option) for option in options])).alias("position", "value")
    )
    rows = slots.join(cells, ["level", "group", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    percent = F.coalesce(share(F.col("n"), F.col("total_n")), F.lit(0.0))
    if withhold:
        percent = F.when(~F.col("group").isin(*withhold), percent)
    return rows.select("level", "group", "value", "position", "n", percent.alias("percent"), "valid_n", "total_n")


def crosstab_grid(df: DataFrame, outcome: str, group: str, options: Sequence[str], groups: Sequence[str]) -> DataFrame:
    return crosstab_levels(df, outcome, {"group": group}, options, {"group": groups}).drop("level")


def crosstab_two_level(
    df: DataFrame, outcome: str, upper: str, lower: str, options: Sequence[str], withhold: Sequence[str] = ()
) -> DataFrame:
    """Overall, upper and lower region side by side."""
    return crosstab_levels(df, outcome, {"upper": upper, "lower": lower}, options, withhold=withhold)


def _combo_counts(df: DataFrame, group: Column, outcome: Column) -> DataFrame:
    return df.select(group.alias("group"), outcome.alias("value")).groupBy("group", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def breakdown_by_group(df: DataFrame, outcome: str, group: str, known: Sequence[str]) -> DataFrame:
    """Combo-aware frequency of outcome inside each group; denominator is the group's size."""
    kinds = kinds_of(df)
    from tallyframe.operators.frequency import split_combos

    counts = _combo_counts(df, text(kinds, group), text(kinds, outcome)).filter(F.col("group").isNotNull())
    sizes = counts.groupBy("group").agg(F.sum("n").alias("n_group"))
    answered = counts.filter(F.col("value").isNotNull()).withColumn("variable", F.lit(outcome))
    tallies = split_combos(answered, {outcome: known}, keys=("variable", "group")).drop("variable")
    return spread_join(tallies, sizes, ["group"], by="value").select(
        "group", "value", "n", "n_group", share(F.col("n"), F.col("n_group")).alias("percent")
    )


def membership_crosstab(df: DataFrame, member: str, outcome: str) -> DataFrame:
    """Overlapping groups: a record belongs to every group its combo names."""
    kinds = kinds_of(df)
    counts = _combo_counts(df, text(kinds, member), text(kinds, outcome)).filter(F.col("group").isNotNull())
    spread = (
        counts.select(F.explode(F.array_distinct(combo_split("group"))).alias("group"), "value", "n")
        .groupBy("group", "value").agg(F.sum("n").alias("n"))
    )
    sizes = spread.groupBy("group").agg(F.sum("n").alias("n_group"))
    return spread_join(spread, sizes, ["group"], by="value").filter(F.col("value").isNotNull() | (F.col("n") > F.col("n_group"))).select(
        "group", "value", "n", "n_group", share(F.col("n"), F.col("n_group")).alias("percent")
    )


def conditional_shares(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Share of rows meeting each named condition, all in one aggregation: (by..., name, n, total_n, percent)."""
    hits = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_n"), *hits)
    long = wide.unpivot([*by, "total_n"], list(conditions), "name", "n")
    return long.select(*by, "name", "n", "total_n", share(F.col("n"), F.col("total_n")).alias("percent"))


def positive_share_pairs(
    df: DataFrame, pairs: Mapping[str, tuple[tuple[str, Sequence[str]], tuple[str, Sequence[str]]]]
) -> DataFrame:
    """For each (does, decides) pair: share of rows with a positive code on either side. A combo counts once."""
    conditions = {}
    for title, sides in pairs.items():
        for side, (column, codes) in zip(("does", "decides"), sides):
            conditions[f"{title}|{side}"] = combo_has(F.col(column).cast("string"), codes, null_as=False)
    rows = conditional_shares(df, conditions)
    return rows.select(
        F.substring_index("name", "|", 1).alias("pair"), F.substring_index("name", "|", -1).alias("side"),
        "n", "total_n", "percent",
    )


def ownership_vs_usage(df: DataFrame, owned: str, usages: Sequence[str]) -> DataFrame:
    """One ownership share beside several usage shares over the same rows."""
    rows = conditional_shares(df, {name: F.col(name) == 1 for name in [owned, *usages]})
    own = rows.withColumn("role", F.when(F.col("name") == owned, "owns").otherwise("uses"))
    return own.select("role", "name", "n", "total_n", "percent")


def conditional_ownership(df: DataFrame, devices: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Per device: share of rows owning it, and among those owners the share held by each person.

    devices maps device -> {person: indicator column}. Several persons may hold one device.
    """
    aggregates, shape = [F.count(F.lit(1)).alias("total_n")], []
    for device, people in devices.items():
        owned = any_of_indicators(*people.values())
        aggregates.append(F.count_if(owned).alias(f"{device}|owners"))
        for person, column in people.items():
            aggregates.append(F.count_if(owned & (F.col(column) == 1)).alias(f"{device}|{person}"))
            shape.append((device, person))
    wide = df.agg(*aggregates)
    cells = [
        F.struct(
            F.lit(device).alias("device"), F.lit(person).alias("person"),
            F.col(f"`{device}|owners`").alias("n_owners"), F.col(f"`{device}|{person}`").alias("n"), F.col("total_n"),
        )
        for device, person in shape
    ]
    return wide.select(F.inline(F.array(*cells))).select(
        "device", "person", "n_owners", "n", "total_n",
        share(F.col("n_owners"), F.col("total_n")).alias("owner_percent"),
        F.coalesce(share(F.col("n"), F.col("n_owners")), F.lit(0.0)).alias("percent"),
    )


def joint_categories(df: DataFrame, first: str, second: str, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """Declared combinations of two columns: n, percent over all rows, rows with both answered, the rest."""
    kinds = kinds_of(df)
    a, b = text(kinds, first), text(kinds, second)
    hits = [
        F.count_if((a == left) & (b == right)).alias(f"_{i}") for i, (left, right) in enumerate(wanted)
    ]
    wide = df.agg(
        F.count(F.lit(1)).alias("total_n"), F.count_if(a.isNotNull() & b.isNotNull()).alias("valid_n"), *hits
    )
    cells = [
        F.struct(F.lit(left).alias("first"), F.lit(right).alias("second"), F.col(f"_{i}").alias("n"))
        for i, (left, right) in enumerate(wanted)
    ]
    return wide.select("total_n", "valid_n", F.inline(F.array(*cells))).select(
        "first", "second", "n", share(F.col("n"), F.col("total_n")).alias("percent"),
        "valid_n", (F.col("total_n") - F.col("valid_n")).alias("missing_n"),
    )


def multi_code_share(df: DataFrame, column: str, codes: Sequence[str], group: str) -> DataFrame:
    """Per group, share of rows with at least one of the codes."""
    hit = combo_has(F.col(column).cast("string"), codes, null_as=False)
    return (
        df.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias("group"))
        .agg(F.count_if(hit).alias("n"), F.count(F.lit(1)).alias("n_group"))
        .withColumn("percent", share(F.col("n"), F.col("n_group")))
    )


def overview_counts(df: DataFrame, region: str, age: str) -> DataFrame:
    """Records per region and over all rows, with mean age."""
    rows = df.select(F.col(region).alias("_region"), F.col(age).alias("_age"))
    return rows.rollup("_region").agg(
        F.grouping("_region").alias("_all"), F.count(F.lit(1)).alias("n"), F.avg("_age").alias("mean_age")
    ).select(F.when(F.col("_all") == 1, ALL_GROUPS).otherwise(F.col("_region")).alias("region"), "n", "mean_age")
