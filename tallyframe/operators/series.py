"""Chart-ready series: the numbers a chart shows, never the drawing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.common import kinds_of, lookup, number, spread_join, text, unpivot
from tallyframe.operators.ranks import quantiles
from tallyframe.operators.reliability import positive_items
from tallyframe.sources.dimensions import small_table

HISTOGRAM_BINS = 12
LOG_SCALE_RATIO = 8
WHISKER_IQR = 1.5


def _bins(counted: DataFrame, edges: DataFrame, bins: int, by: Sequence[str]) -> DataFrame:
    """All bins incl. empty ones, from per-bin counts and per-key (low, high) edges."""
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    slots = edges.select(*by, "low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return slots.join(counted, [*by, "bin"], "left").select(
        *by, "bin", (F.col("low") + F.col("bin") * width).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_high"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over each column's range, the top edge belonging to the last bin.
    A constant column spans half a unit to either side."""
    kinds = kinds_of(df)
    long = unpivot(df, {name: number(kinds, name) for name in columns}, value="x").filter(F.col("x").isNotNull())
    span = long.groupBy("variable").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    flat = F.col("low") == F.col("high")
    edges = span.select(
        "variable", F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    place = F.floor((F.col("x") - F.col("low")) / ((F.col("high") - F.col("low")) / F.lit(float(bins)))).cast("int")
    placed = lookup(long, edges, ["variable"]).select("variable", F.least(place, F.lit(bins - 1)).alias("bin"))
    counted = placed.groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    return _bins(counted, edges, bins, ["variable"])


def index_histogram(df: DataFrame, index: str, bins: int = HISTOGRAM_BINS, low: float = 0.0, high: float = 100.0) -> DataFrame:
    """Bins over a fixed range, with the mean of the values on every row."""
    kinds = kinds_of(df)
    x = number(kinds, index)
    place = F.least(F.floor((x - low) / F.lit((high - low) / bins)).cast("int"), F.lit(bins - 1))
    base = df.select(x.alias("x"), place.alias("bin")).filter("x is not null")
    per_bin = base.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("_mean"))
    edges = small_table(df.sparkSession, [(float(low), float(high))], "low double, high double")
    rows = _bins(per_bin.select("bin", "n"), edges, bins, [])
    mean = per_bin.agg((F.sum(F.col("n") * F.col("_mean")) / F.sum("n")).alias("mean"))
    return rows.withColumn("mean", mean.scalar())


def box_plot(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles per group, whiskers at the outermost values within 1.5 IQR, number of points beyond."""
    kinds = kinds_of(df)
    rows = df.select(text(kinds, group).alias("group"), number(kinds, value).alias("x")).dropna()
    counts = rows.groupBy("group", "x").agg(F.count(F.lit(1)).alias("n"))
    box = quantiles(counts, ["group"], "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, bound_keys=[])
    reach = (F.col("q3") - F.col("q1")) * WHISKER_IQR
    inside = F.col("x").between(F.col("q1") - reach, F.col("q3") + reach)
    return spread_join(counts, box, ["group"], by="x").groupBy("group", "q1", "median", "q3").agg(
        F.sum("n").alias("n"), F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
    )


def bar_series(frequency: DataFrame) -> DataFrame:
    """Non-empty categories; all of them where every one is empty."""
    largest = frequency.groupBy("variable").agg(F.max("n").alias("_largest"))
    rows = lookup(frequency, largest, ["variable"])
    return rows.filter((F.col("n") > 0) | (F.col("_largest") == 0)).select("variable", "value", "n", "percent")


def stacked_series(summary: DataFrame, options: Sequence[str]) -> DataFrame:
    """Matrix summary as row x option percents, one column per option."""
    return summary.groupBy("row").pivot("option", list(options)).agg(F.first("percent"))


def radar_series(df: DataFrame, columns: Sequence[str], positive_codes: Sequence[str], region: str) -> DataFrame:
    """Share of positive answers x100 per item and region."""
    items = positive_items(columns, positive_codes)
    wide = df.filter(F.col(region).isNotNull()).groupBy(F.col(region).alias("region")).agg(
        *[(F.avg(item) * 100).alias(name) for name, item in items.items()]
    )
    return wide.unpivot(["region"], list(columns), "item", "value")


def forest_series(effects: DataFrame) -> DataFrame:
    """Odds ratios with their side of 1, and whether their spread calls for a log axis."""
    usable = effects.filter(F.col("odds_ratio").isNotNull())
    # One row per declared effect, so the window over all of them is small.
    whole = Window.partitionBy()
    positive = F.when(F.col("odds_ratio") > 0, F.col("odds_ratio"))
    return usable.select(
        "variable_a", "variable_b", "odds_ratio",
        F.when(F.col("odds_ratio") >= 1, "higher").otherwise("lower").alias("side"),
        F.coalesce(F.max(positive).over(whole) / F.min(positive).over(whole) > LOG_SCALE_RATIO, F.lit(False)).alias("log_scale"),
    )


def scree_series(spark, eigenvalues: Sequence[float]) -> DataFrame:
    return small_table(spark, [(i + 1, float(v)) for i, v in enumerate(eigenvalues)], "factor int, eigenvalue double")


def variance_explained_series(effects: DataFrame) -> DataFrame:
    """Eta squared x100 per pair."""
    return effects.filter(F.col("eta_squared").isNotNull()).select(
        "category", "outcome", (F.col("eta_squared") * 100).alias("percent_explained"), "n"
    )


def top_two_categories(frequency: DataFrame) -> DataFrame:
    """Largest and second largest category of each variable, with its missing count."""
    from tallyframe.operators.frequency import top_categories

    return top_categories(frequency, 2).select("variable", "position", "value", "n", "percent", "missing_n")


def top_three_options(options: DataFrame) -> DataFrame:
    """The three most chosen options that anyone chose. options: (option, n, percent)."""
    return options.filter("n > 0").orderBy(F.col("percent").desc(), "option").limit(3)
