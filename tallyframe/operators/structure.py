"""Factors and segments. Passes over the records are MLlib or aggregates; only k x k matrices come to the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.clusters import ClusterModel, cluster_of, fit, silhouettes, vector_blocks
from tallyframe.operators.common import lookup, unpivot
from tallyframe.operators.ranks import quantiles
from tallyframe.plans.session import checkpoint_dir
from tallyframe.sources.dimensions import small_table

# The analysis settings of the reference study design.
MIN_ROWS_PER_ITEM = 5.0
MIN_LOADING = 0.4
CLUSTER_COUNTS = (2, 3, 4)
CLUSTER_RESTARTS = 10
CLUSTER_SEED = 42
MAX_ITERATIONS = 300
HIGHLIGHTS = 4
# A rotation ends when a sweep turns no pair of factors by more than this angle.
VARIMAX_SWEEPS, VARIMAX_ANGLE = 200, 1e-9


def _assembled(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error").transform(df)


def _correlation(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, int]:
    """Pearson matrix of the complete rows and their number, in one aggregate: a constant item correlates 0 with the
    others and 1 with itself."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    rows = df.select(*[F.col(name).cast("double") for name in columns]).dropna()
    found = rows.agg(
        F.count(F.lit(1)).alias("n"), *[F.covar_pop(a, b).alias(f"c{at}") for at, (a, b) in enumerate(pairs)],
        *[F.stddev_pop(name).alias(f"s{at}") for at, name in enumerate(columns)],
    ).first()
    matrix, place = np.eye(len(columns)), {name: at for at, name in enumerate(columns)}
    for at, (a, b) in enumerate(pairs):
        i, j = place[a], place[b]
        scale = (found[f"s{i}"] or 0.0) * (found[f"s{j}"] or 0.0)
        matrix[i, j] = matrix[j, i] = found[f"c{at}"] / scale if scale else 0.0
    return matrix, found.n


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    return _correlation(df, columns)[0]


def item_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    matrix = correlation_matrix(df, columns)
    rows = [(a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return small_table(df.sparkSession, rows, "item_a string, item_b string, r double")


def _varimax(loadings: np.ndarray) -> np.ndarray:
    """Varimax by planar rotations. Turning two factors x, y by an angle t changes the criterion like a sine of 4t, so
    the best angle is known in closed form: with u = x^2 - y^2 and v = 2xy, tan 4t = (2 sum uv - 2 sum u sum v / p) /
    (sum (u^2 - v^2) - ((sum u)^2 - (sum v)^2) / p). Sweeps over all pairs end when no angle is worth turning."""
    turned, items = loadings.copy(), loadings.shape[0]
    for _ in range(VARIMAX_SWEEPS):
        largest = 0.0
        for a, b in combinations(range(turned.shape[1]), 2):
            x, y = turned[:, a], turned[:, b]
            u, v = x * x - y * y, 2 * x * y
            sine = 2 * (u @ v) - 2 * u.sum() * v.sum() / items
            cosine = u @ u - v @ v - (u.sum() ** 2 - v.sum() ** 2) / items
            angle = np.arctan2(sine, cosine) / 4
            turned[:, a], turned[:, b] = x * np.cos(angle) + y * np.sin(angle), y * np.cos(angle) - x * np.sin(angle)
            largest = max(largest, abs(angle))
        if largest < VARIMAX_ANGLE:
            break
    return turned


@dataclass(frozen=True)
class FactorResult:
    loadings: DataFrame
    eigenvalues: list[float]
    n_factors: int
    n_rows: int
    few_rows: bool


def factor_extraction(df: DataFrame, columns: Sequence[str]) -> FactorResult:
    """Kaiser rule on the item correlations, varimax-rotated loadings (item, factor, loading).
    Signs are fixed so that each factor's largest loading is positive."""
    matrix, n_rows = _correlation(df, columns)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = max(1, min(int((values > 1.0).sum()), len(columns)))
    raw = vectors[:, :kept] * np.sqrt(np.clip(values[:kept], 0.0, None))
    rotated = _varimax(raw) if kept > 1 else raw
    strongest = rotated[np.abs(rotated).argmax(axis=0), np.arange(kept)]
    rotated = rotated * np.where(strongest < 0, -1.0, 1.0)
    rows = [(name, f + 1, float(rotated[i, f])) for i, name in enumerate(columns) for f in range(kept)]
    return FactorResult(
        small_table(df.sparkSession, rows, "item string, factor int, loading double"),
        [float(value) for value in values], kept, n_rows, n_rows / max(len(columns), 1) < MIN_ROWS_PER_ITEM,
    )


def factor_grouping(loadings: DataFrame, threshold: float = MIN_LOADING) -> DataFrame:
    """Items by the factor they load on most, when strongly enough; groups of two or more."""
    dominant = loadings.groupBy("item").agg(
        F.max(F.struct(F.abs("loading").alias("size"), (-F.col("factor")).alias("_order"))).alias("best")
    ).filter(F.col("best.size") >= threshold)
    grouped = dominant.groupBy((-F.col("best._order")).alias("factor")).agg(F.array_sort(F.collect_list("item")).alias("items"))
    return grouped.filter(F.size("items") >= 2)


# ---- segments -------------------------------------------------------------------------------------

def segment_features(df: DataFrame, features: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[column.cast("double").alias(name) for name, column in features.items()])


def impute_central(df: DataFrame, median_columns: Sequence[str] = (), mode_columns: Sequence[str] = ()) -> DataFrame:
    """Fill index columns with their median and indicators with their mode (smallest among equals, 0 if empty).

    The fill values are one aggregated row, attached as scalar subqueries.
    """
    columns = [*median_columns, *mode_columns]
    counts = unpivot(df, {name: F.col(name).cast("double") for name in columns}, value="x").filter(
        F.col("x").isNotNull()
    ).groupBy("variable", "x").agg(F.count(F.lit(1)).alias("n"))
    fills = {}
    if median_columns:
        middle = quantiles(counts.filter(F.col("variable").isin(*median_columns)), ["variable"], "x", {"m": 0.5})
        fills |= {name: middle.filter(F.col("variable") == name).select("m").scalar() for name in median_columns}
    if mode_columns:
        best = counts.groupBy("variable").agg(F.max(F.struct("n", (-F.col("x")).alias("_x"))).alias("b"))
        fills |= {
            name: F.coalesce(best.filter(F.col("variable") == name).select(-F.col("b._x")).scalar(), F.lit(0.0))
            for name in mode_columns
        }
    return df.withColumns({name: F.coalesce(F.col(name).cast("double"), fill) for name, fill in fills.items()})


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """z-scores with the population standard deviation; a constant column becomes 0."""
    moments = df.agg(
        *[F.avg(name).alias(f"{name}|m") for name in columns], *[F.stddev_pop(name).alias(f"{name}|s") for name in columns]
    )

    def moment(name: str, part: str) -> Column:
        return moments.select(f"`{name}|{part}`").scalar()

    return df.withColumns({
        name: (F.col(name) - moment(name, "m")) / F.when(moment(name, "s") > 0, moment(name, "s")).otherwise(1.0) for name in columns
    })


@dataclass(frozen=True)
class Segments:
    assigned: DataFrame
    scores: DataFrame
    best_k: int


def kmeans_sweep(
    df: DataFrame, columns: Sequence[str], ks: Sequence[int] = CLUSTER_COUNTS, restarts: int = CLUSTER_RESTARTS, seed: int = CLUSTER_SEED,
    blocks: DataFrame | None = None,
) -> dict[int, ClusterModel]:
    """Per k, the restart with the lowest cost. df holds complete, standardised columns; all runs step together over
    the blocks of its distinct vectors (clusters.vector_blocks), and depend on the rows alone."""
    blocks = vector_blocks(df, columns) if blocks is None else blocks
    return fit(df, blocks, columns, ks, restarts, seed, MAX_ITERATIONS)


def silhouette_select(df: DataFrame, columns: Sequence[str], models: Mapping[int, ClusterModel], blocks: DataFrame | None = None) -> tuple[dict[int, float], int]:
    """Mean silhouette per k, with plain Euclidean distance, and the best k, the smallest of equal ones. The cost is the
    square of the number of distinct vectors (clusters.silhouettes)."""
    blocks = vector_blocks(df, columns) if blocks is None else blocks
    scores = silhouettes(blocks, len(columns), {k: model.centres for k, model in models.items()})
    return scores, max(sorted(scores), key=lambda k: round(scores[k], 9))


def assign_clusters(df: DataFrame, columns: Sequence[str], model: ClusterModel) -> DataFrame:
    return df.withColumn("cluster", cluster_of(columns, model.centres))


def segment(df: DataFrame, id_column: str, columns: Sequence[str], **options) -> Segments:
    """Standardise, sweep, choose k. assigned: (id, cluster) with the chosen model."""
    checkpoint_dir(df.sparkSession)
    scaled = standardise(df.select(id_column, *columns), columns).checkpoint()
    blocks = vector_blocks(scaled, columns)
    models = kmeans_sweep(scaled, columns, blocks=blocks, **options)
    scores, best = silhouette_select(scaled, columns, models, blocks)
    table = small_table(df.sparkSession, [(k, float(s), k == best) for k, s in scores.items()], "k int, silhouette double, chosen boolean")
    return Segments(assign_clusters(scaled, columns, models[best]).select(id_column, "cluster"), table, best)


def cluster_profile(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Size, share of all rows and raw-unit means per cluster."""
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *[F.avg(name).alias(name) for name in columns])
    # One row per cluster.
    return sizes.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def cluster_highlights(df: DataFrame, columns: Sequence[str], cluster: str = "cluster", top_n: int = HIGHLIGHTS) -> DataFrame:
    """The features whose cluster mean departs most from the overall mean, with the direction."""
    per_cluster = df.groupBy(cluster).agg(*[F.avg(name).alias(name) for name in columns]).unpivot([cluster], list(columns), "feature", "mean")
    overall = df.agg(*[F.avg(name).alias(name) for name in columns]).unpivot([], list(columns), "feature", "overall")
    gap = F.col("mean") - F.col("overall")
    order = Window.partitionBy(cluster).orderBy(F.abs(gap).desc(), "feature")
    return lookup(per_cluster, overall, ["feature"]).withColumn("position", F.row_number().over(order)).filter(
        F.col("position") <= top_n
    ).select(cluster, "position", "feature", "mean", "overall", F.when(gap > 0, "higher").otherwise("lower").alias("direction"))


def pca_2d(df: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """Two-component projection of centred columns, each axis signed by its largest loading."""
    means = df.agg(*[F.avg(name).alias(name) for name in columns])
    centred = df.select(id_column, *[(F.col(name) - means.select(name).scalar()).alias(name) for name in columns])
    vectors = _assembled(centred, columns)
    model = PCA(k=2, inputCol="features", outputCol="projected").fit(vectors)
    axes = model.pc.toArray()
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    point = vector_to_array("projected")
    return model.transform(vectors).select(
        id_column, (point[0] * float(signs[0])).alias("axis_1"), (point[1] * float(signs[1])).alias("axis_2")
    )
