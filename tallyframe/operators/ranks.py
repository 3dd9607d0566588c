"""Order statistics without a single-task sort.

Everything here starts from counts per distinct value, so a value held by a third of all rows is one
row. Distinct values are then cut into buckets at the points of a quantile sketch, a state of fixed size.
Running totals are taken inside each bucket and shifted by the totals of the buckets before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.common import lookup

LEAST_BUCKETS = 32
# Sketch entries a boundary.
SKETCH = 4
HOT_SHARE = 0.01
SALTS = 256


def bucket_count(df: DataFrame) -> int:
    """Buckets of a key: a few for each of the tasks the session shuffles into, so they follow the cluster."""
    return max(LEAST_BUCKETS, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _bucketed(counts: DataFrame, bounded: Sequence[str], value: str, n: str, buckets: int | None) -> DataFrame:
    """Add `_bucket`, increasing with value within each combination of the bounded keys.

    Boundaries are the points of a quantile sketch: a mergeable state of fixed size for each combination, however
    many values there are. Ranks are exact whatever the boundaries, so the sketch may be coarse."""
    buckets = buckets or bucket_count(counts)
    # n > 0 always holds; naming n keeps this branch on the shuffle that the other branches read.
    points = F.percentile_approx(F.when(F.col(n) > 0, F.col(value)), [at / buckets for at in range(1, buckets)], SKETCH * buckets)
    cuts = counts.groupBy(*bounded).agg(F.array_sort(F.array_distinct(points)).alias("_cuts"))
    placed = lookup(counts, cuts, bounded, how="left").withColumn("_bucket", F.lit(0))
    # The number of cuts below the value by halving: one column after the other, each a plain expression.
    for half in range(buckets.bit_length() - 1, -1, -1):
        step = F.lit(1 << half)
        placed = placed.withColumn("_bucket", F.col("_bucket") + F.when(F.get("_cuts", F.col("_bucket") + step - 1) < F.col(value), step).otherwise(0))
    return placed.drop("_cuts")


def _offsets(bucketed: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    """Rows before and in each bucket, and the total, per key. A key has at most bucket_count() of them."""
    order = Window.partitionBy(*keys).orderBy("_bucket")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return bucketed.groupBy(*keys, "_bucket").agg(F.sum(n).alias("_n")).select(
        *keys, "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"), "_n",
        F.sum("_n").over(whole).alias("total"),
    )


def cumulative_counts(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    n: str = "n",
    bound_keys: Sequence[str] | None = None,
    buckets: int | None = None,
    only: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """Add `ties` (rows with this value), `cum` (rows up to and including it) and `total`, per key.

    counts holds weights n per (keys, value), possibly split further by other columns. bound_keys is
    the part of keys whose number of combinations is fixed by declared columns (default all of them);
    boundaries are kept per combination of those, so what is broadcast never exceeds combinations x
    buckets values. With none of them bounded, one set of boundaries serves all keys.
    only(before, rows, total) keeps just the buckets it holds for, before any row is shuffled for ranking.
    """
    keys = list(keys)
    bounded = list(keys if bound_keys is None else bound_keys)
    all_bounded = bounded == keys
    if not bounded:
        counts, bounded = counts.withColumn("_whole", F.lit(0)), ["_whole"]
    bucketed = _bucketed(counts, bounded, value, n, buckets)
    offsets = _offsets(bucketed, keys, n)
    if only is not None:
        offsets = offsets.filter(only(F.col("_offset"), F.col("_n"), F.col("total")))
    by_value = Window.partitionBy(*keys, "_bucket").orderBy(value)
    return (
        lookup(bucketed, offsets.drop("_n"), [*keys, "_bucket"], bounded=all_bounded)
        .withColumns({
            "ties": F.sum(n).over(by_value.rangeBetween(Window.currentRow, Window.currentRow)),
            "cum": F.col("_offset") + F.sum(n).over(by_value.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
        })
        .drop("_bucket", "_offset", "_whole")
    )


def midranks(counts: DataFrame, keys: Sequence[str], value: str, n: str = "n", **options) -> DataFrame:
    """Average rank of each distinct value (ties share the mean of their positions)."""
    ranked = cumulative_counts(counts, keys, value, n, **options)
    return ranked.withColumn("midrank", F.col("cum") - (F.col("ties") - 1) / F.lit(2.0))


def quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float], n: str = "n", **options
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per named probability."""
    def holds_one(before: Column, rows: Column, total: Column) -> Column:
        """Does the bucket hold a row some quantile is made of?"""
        found = F.lit(False)
        for probability in probabilities.values():
            low = F.floor((total - 1) * F.lit(float(probability)))
            found = found | ((low + 1 >= before) & (low < before + rows))
        return found

    ranked = cumulative_counts(counts, keys, value, n, only=holds_one, **options)
    picks, shape = [], []
    for name, probability in probabilities.items():
        position = (F.col("total") - 1) * F.lit(float(probability))
        low = F.floor(position)
        high = F.least(low + 1, F.col("total") - 1)

        def at(index: Column) -> Column:
            return F.max(F.when((F.col("cum") - F.col(n) <= index) & (index < F.col("cum")), F.col(value)))

        picks += [at(low).alias(f"_{name}_low"), at(high).alias(f"_{name}_high"), F.max(position - low).alias(f"_{name}_part")]
        step = F.col(f"_{name}_high") - F.col(f"_{name}_low")
        shape.append((F.col(f"_{name}_low") + step * F.col(f"_{name}_part")).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *shape)


def suffix_min(rows: DataFrame, keys: Sequence[str], value: str, measure: str, n: str = "n", **options) -> DataFrame:
    """Replace measure by its minimum over this and all larger values of the key: per bucket first, then
    inside each bucket, so no key is ever sorted by one task. One row per (keys, value)."""
    keys = list(keys)
    whole = rows.withColumn("_whole", F.lit(0))
    bucketed = _bucketed(whole, ["_whole"], value, n, options.get("buckets"))
    later = Window.partitionBy(*keys).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lowest = bucketed.groupBy(*keys, "_bucket").agg(F.min(measure).alias("_low")).select(
        *keys, "_bucket", F.min("_low").over(later).alias("_later")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, 0)
    joined = bucketed.join(lowest, [*keys, "_bucket"])
    return joined.withColumn(measure, F.least(F.min(measure).over(inside), F.col("_later"))).drop("_bucket", "_later", "_whole")


def join_ranks(
    rows: DataFrame, ranks: DataFrame, counts: DataFrame, keys: Sequence[str], value: str, spread: str
) -> DataFrame:
    """Attach `midrank` to rows by (keys, value) without piling a frequent value onto one task.

    counts holds n per (keys, value), ranks the same with `midrank`. A value behind more than HOT_SHARE of
    the rows of its key, of which a key has at most 1/HOT_SHARE, is known to the rows by broadcast: they scatter
    over SALTS salts, and its rank is copied to each of them. Every other value meets its one rank.
    """
    by = [*keys, value]
    weighed = lookup(counts.select(*by, "n"), counts.groupBy(*keys).agg(F.sum("n").alias("_all")), keys)
    frequent = weighed.filter(F.col("n") >= F.col("_all") * HOT_SHARE).select(*by, F.lit(True).alias("_hot"))
    scattered = F.col("_hot") | F.col(value).isNull()
    salt = F.when(scattered, F.pmod(F.hash(spread), F.lit(SALTS))).otherwise(0)
    salted = rows.join(F.broadcast(frequent), by, "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    marked = ranks.select(*by, "midrank").join(F.broadcast(frequent), by, "left")
    return salted.join(marked.select(*by, "midrank", F.explode(copies).alias("_salt")), [*by, "_salt"], "left").drop("_salt")
