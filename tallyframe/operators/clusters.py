"""k-means and silhouettes over weighted distinct vectors, in blocks that are multiplied whole.

Equal vectors are one vector with a weight, so nothing depends on how rows are dealt. All runs of a sweep, for every
number of clusters and every restart, take each step together in one aggregate; k x d centres are all that the
driver holds."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.plans.session import checkpoint_dir

#: Blocks in a part of either side of the silhouettes' pairs, on average; a task meets one part with another.
TARGETS, SOURCES = 2, 512
#: Vectors whose distances are taken at once, and bytes of blocks that Python is handed at once.
STRETCH, BATCH_BYTES = 32, 16 << 20
#: Vectors in a block; coordinates and squared distances count to DIGITS digits, so that ties do not hang on the order of a sum.
BLOCK, DIGITS = 1_024, 9
#: A run ends when its centres move by no more than this, as the sum of their squared ways in units of the coordinates.
TOLERANCE = 1e-4
BLOCK_SCHEMA = "block string, weights array<double>, cells array<double>"


@dataclass(frozen=True)
class ClusterModel:
    """Centres of one run, the weight of each cluster, and the sum of squared distances to the centres."""

    restart: int
    centres: np.ndarray
    sizes: np.ndarray
    cost: float


def distinct_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """x0, x1, ..., weight: each distinct vector once, with its number of rows. A missing coordinate is an error."""
    cells = [F.round(F.coalesce(F.col(name).cast("double"), F.raise_error(F.lit(f"{name} has missing values")).cast("double")), DIGITS).alias(f"x{k}") for k, name in enumerate(columns)]
    return df.select(*cells).groupBy(*[f"x{k}" for k in range(len(columns))]).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def vector_blocks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct vectors in blocks of at most BLOCK, written to the checkpoint folder: block, weights, cells (vector by vector)."""
    checkpoint_dir(df.sparkSession)
    names = [f"x{k}" for k in range(len(columns))]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                cells = np.stack([part.column(name).to_numpy(zero_copy_only=False) for name in names], axis=1)
                yield _rows(BLOCK_SCHEMA, [("", part.column("weight").to_pylist(), cells.ravel().tolist())])

    # Blocks are named by what they hold, not by where they were made.
    packed = distinct_vectors(df, columns).select(*names, "weight").mapInArrow(pack, BLOCK_SCHEMA)
    return packed.withColumn("block", F.md5(F.to_json(F.struct("weights", "cells")))).checkpoint()


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "array<double>": pa.list_(pa.float64())}
    fields = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([row[k] for row in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def _block_arrays(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(batch.num_rows):
        yield batch.column("weights")[at].values.to_numpy(), batch.column("cells")[at].values.to_numpy().reshape(-1, width)


def _sum_blocks(blocks: DataFrame, width: int, size: int, add: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> np.ndarray:
    """add(total, weights, cells) over all blocks, as one vector of `size` numbers summed up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for weights, cells in _block_arrays(batch, width):
                add(total, weights, cells)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["slot", "value"])

    found = blocks.mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    out[[row.slot for row in found]] = [row.value for row in found]
    return out


def _apart(cells: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of each vector to each centre."""
    gaps = cells[:, None, :] - centres[None, :, :]
    return np.round(np.einsum("nkd,nkd->nk", gaps, gaps), DIGITS)


def _step(blocks: DataFrame, width: int, runs: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each run's centres: weight and sum of the vectors nearest to each, and the cost. The first of equally near centres counts."""
    sizes = [len(centres) * (width + 1) + 1 for centres in runs]
    starts = np.concatenate(([0], np.cumsum(sizes)))

    def add(total: np.ndarray, weights: np.ndarray, cells: np.ndarray) -> None:
        for centres, start in zip(runs, starts):
            apart = _apart(cells, centres)
            nearest = apart.argmin(axis=1)
            chosen = np.zeros(apart.shape)
            chosen[np.arange(len(nearest)), nearest] = weights
            k = len(centres)
            total[start : start + k] += chosen.sum(axis=0)
            total[start + k : start + k * (width + 1)] += (chosen.T @ cells).ravel()
            total[start + k * (width + 1)] += weights @ apart.min(axis=1)

    total = _sum_blocks(blocks, width, int(starts[-1]), add)
    parts = [total[a:b] for a, b in zip(starts[:-1], starts[1:])]
    return [(part[:k], part[k:-1].reshape(k, width), float(part[-1])) for part, k in zip(parts, (len(centres) for centres in runs))]


def start_centres(df: DataFrame, columns: Sequence[str], most: int, restarts: int, seed: int) -> list[np.ndarray]:
    """For each restart `most` distinct vectors, drawn in proportion to their weights: a number from the MD5 of seed, restart
    and coordinates gives each vector a waiting time, and the shortest win. The same rows always give the same centres."""
    names = [f"x{k}" for k in range(len(columns))]
    vectors = distinct_vectors(df, columns)
    whole = [F.round(F.col(name) * 1_000_000).cast("bigint").cast("string") for name in names]
    digests = [F.md5(F.concat_ws(",", F.lit(str(seed)), F.lit(str(group)), *whole)) for group in range((restarts + 3) // 4)]
    draws = [(F.conv(F.substring(digests[r // 4], 8 * (r % 4) + 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0 for r in range(restarts)]
    waits = vectors.select(F.array(*names).alias("cells"), *[(-F.log(draw) / F.col("weight")).alias(f"t{r}") for r, draw in enumerate(draws)])

    def shortest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in range(restarts)]
        for batch in batches:
            for r in range(restarts):
                times = batch.column(f"t{r}").to_numpy(zero_copy_only=False)
                for at in np.argsort(times, kind="stable")[:most]:
                    best[r].append((float(times[at]), batch.column("cells")[int(at)].as_py()))
                best[r] = sorted(best[r])[:most]
        yield _rows("run int, wait double, cells array<double>", [(r, *row) for r, rows in enumerate(best) for row in rows])

    kept = waits.mapInArrow(shortest, "run int, wait double, cells array<double>")
    place = F.row_number().over(Window.partitionBy("run").orderBy("wait", "cells"))
    found = kept.withColumn("place", place).where(F.col("place") <= most).orderBy("run", "place").collect()
    return [np.array([row.cells for row in found if row.run == r]).reshape(-1, len(columns)) for r in range(restarts)]


def fit(df: DataFrame, blocks: DataFrame, columns: Sequence[str], ks: Sequence[int], restarts: int, seed: int, most_steps: int) -> dict[int, ClusterModel]:
    """For each k the restart with the lowest cost, the earliest of equal ones. A centre without vectors stays where it is."""
    width = len(columns)
    starts = start_centres(df, columns, max(ks), restarts, seed)
    keys = [(k, r) for k in ks for r in range(restarts)]
    centres = {(k, r): starts[r][:k] for k, r in keys}
    open_ = list(keys)
    for _ in range(most_steps):
        if not open_:
            break
        moved = []
        for key, (sizes, sums, _) in zip(open_, _step(blocks, width, [centres[key] for key in open_])):
            new = np.where(sizes[:, None] > 0, np.round(sums / np.maximum(sizes, 1e-300)[:, None], DIGITS), centres[key])
            if ((new - centres[key]) ** 2).sum() > TOLERANCE:
                moved.append(key)
            centres[key] = new
        open_ = moved
    best: dict[int, ClusterModel] = {}
    for (k, r), (sizes, _, cost) in zip(keys, _step(blocks, width, [centres[key] for key in keys])):
        if k not in best or round(cost, 6) < round(best[k].cost, 6):
            best[k] = ClusterModel(r, centres[k, r], sizes, cost)
    return best


def cluster_of(columns: Sequence[str], centres: np.ndarray) -> Column:
    """The nearest centre's number, from 0, in plain expressions."""
    apart = F.array(*[
        F.round(sum(((F.round(F.col(name).cast("double"), DIGITS) - F.lit(float(value))) ** 2 for name, value in zip(columns, centre)), F.lit(0.0)), DIGITS)
        for centre in centres
    ])
    return (F.array_position(apart, F.array_min(apart)) - 1).cast("int")


def distance_sums(blocks: DataFrame, width: int, models: Mapping[int, np.ndarray]) -> DataFrame:
    """block, part, sums: for each vector of a block its distances to all vectors of a part, added up by cluster of each set of
    centres, vector by vector.

    The blocks are dealt twice, about TARGETS to a part and SOURCES to a part, and each task measures one part against the other.
    A block travels twice, not once for each block it meets, and leaves one row for each part of SOURCES blocks."""
    blocks.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    summed = "block string, part int, sums array<double>"

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, part, total = None, 0, np.zeros(0)
        for batch in batches:
            for at in range(batch.num_rows):
                mine, weights, other = (batch.column(column)[at].values.to_numpy() for column in ("cells", "source_weights", "source_cells"))
                other = other.reshape(-1, width)
                held = np.concatenate([_membership(other, centres, weights) for centres in models.values()], axis=1)
                sums = _summed_distances(mine.reshape(-1, width), other, held).ravel()
                target = batch.column("target")[at].as_py()
                if target != name:
                    if name is not None:
                        yield _rows(summed, [(name, part, total.tolist())])
                    name, total = target, np.zeros(len(sums))
                part = batch.column("part")[at].as_py()
                total += sums
        if name is not None:
            yield _rows(summed, [(name, part, total.tolist())])

    n = blocks.count()
    source = blocks.select(F.col("weights").alias("source_weights"), F.col("cells").alias("source_cells"), "block").repartition(n // SOURCES + 1, "block")
    source = source.select("source_weights", "source_cells", F.spark_partition_id().alias("part"))
    target = blocks.select(F.col("block").alias("target"), "cells").repartition(n // TARGETS + 1, "target")
    # Spark's cartesian product meets the parts pair by pair; the rows of one target come one after the other.
    return target.hint("shuffle_replicate_nl").crossJoin(source).mapInArrow(pair, summed)


def silhouettes(blocks: DataFrame, width: int, models: Mapping[int, np.ndarray]) -> dict[int, float]:
    """Mean silhouette with plain Euclidean distance for each set of centres.

    Every distinct vector needs its mean distance to each cluster, so the work grows with the square of the number of distinct
    vectors, whatever their weights: n rows with v distinct vectors cost v * v distances. What is shuffled does not (distance_sums)."""
    offsets = np.concatenate(([0], np.cumsum([len(centres) for centres in models.values()])))
    lists = distance_sums(blocks, width, models).groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "sums"))).alias("parts"))
    sizes = [size for size, _, _ in _step(blocks, width, list(models.values()))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(models))
        for batch in batches:
            for at, (weights, cells) in enumerate(_block_arrays(batch, width)):
                parts = batch.column("parts")[at].values.field("sums")
                sums = sum(one.values.to_numpy() for one in parts).reshape(len(cells), -1)
                for m, (centres, size) in enumerate(zip(models.values(), sizes)):
                    total[m] += weights @ _silhouette(sums[:, offsets[m] : offsets[m + 1]], _apart(cells, centres).argmin(axis=1), size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(models), dtype=np.int32)), pa.array(total)], names=["slot", "value"])

    found = {row.slot: row.value for row in blocks.join(lists, "block").mapInArrow(score, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect()}
    return {k: found.get(m, 0.0) / max(size.sum(), 1.0) for m, (k, size) in enumerate(zip(models, sizes))}


def _summed_distances(mine: np.ndarray, other: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Distances of each of mine to all others, added up by held, in stretches that stay in the processor's cache."""
    out = np.empty((len(mine), held.shape[1]))
    columns = np.ascontiguousarray(other.T)
    apart, gap = np.empty((STRETCH, len(other))), np.empty((STRETCH, len(other)))
    for start in range(0, len(mine), STRETCH):
        part = mine[start : start + STRETCH]
        here, step = apart[: len(part)], gap[: len(part)]
        here.fill(0.0)
        for k, column in enumerate(columns):
            np.subtract(part[:, k, None], column[None, :], out=step)
            np.multiply(step, step, out=step)
            np.add(here, step, out=here)
        out[start : start + STRETCH] = np.sqrt(here, out=here) @ held
    return out


def _membership(cells: np.ndarray, centres: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros((len(cells), len(centres)))
    out[np.arange(len(cells)), _apart(cells, centres).argmin(axis=1)] = weights
    return out


def _silhouette(sums: np.ndarray, own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Silhouettes of vectors from their summed distances to each cluster: 0 for one alone in its cluster."""
    at = np.arange(len(own))
    inside = sums[at, own] / np.maximum(sizes[own] - 1, 1)
    means = np.where(sizes > 0, sums / np.maximum(sizes, 1), np.inf)
    means[at, own] = np.inf
    outside = means.min(axis=1, initial=np.inf)
    most = np.maximum(inside, outside)
    return np.where((sizes[own] > 1) & np.isfinite(outside) & (most > 0), (outside - inside) / np.where(most > 0, most, 1), 0.0)
