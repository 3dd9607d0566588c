"""Sums over pairs of variables from one block of ranks: every number is ranked once for each set of rows it can be
paired on, and blocks of records are multiplied with each other, so what is shuffled grows with records times
variables and not with records times pairs."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.common import kinds_of, lookup, number, text
from tallyframe.operators.ranks import HOT_SHARE, SALTS, _bucketed
from tallyframe.plans.session import checkpoint_dir

Pair = tuple[str, str]
#: Cells of a block handled at once, and levels a task keeps before it hands their sums on.
CELLS, LEVELS = 1 << 20, 10_000
#: A number with at most this many distinct values has its ranks broadcast; of those with more, so many are joined one by one.
BROADCAST_VALUES, JOINED = 10_000, 4
SUMS = ("n", "s1", "s2", "s3", "s4")


def _written(df: DataFrame, *partitions: str) -> DataFrame:
    """The rows, written below the checkpoint folder and read from there, so that every reader sees the same ones."""
    path = f"{checkpoint_dir(df.sparkSession)}/rank-block-{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def distinct_records(df: DataFrame, numbers: list[str], categories: list[str]) -> DataFrame:
    """The analysed cells of each distinct record, with how many records have them (weight) and a key (id_a, id_b) of
    128 bits; written, so that every reader sees the same rows."""
    kinds = kinds_of(df)
    cells = df.select(*[number(kinds, name).alias(f"x{k}") for k, name in enumerate(numbers)], *[text(kinds, name).alias(f"g{k}") for k, name in enumerate(categories)])
    counted = cells.groupBy(*cells.columns).agg(F.count(F.lit(1)).alias("weight"))
    # Nulls do not change a hash: a mask of them is hashed along.
    gaps = F.concat(*[F.when(F.col(name).isNull(), "0").otherwise("1") for name in cells.columns])
    keys = [F.xxhash64(F.lit(seed), gaps, *cells.columns) for seed in (1, 2)]
    return _written(counted).withColumns({"id_a": keys[0], "id_b": keys[1]})


def presence_classes(records: DataFrame, columns: list[str]) -> dict[str, int]:
    """Columns by the set of records that have them: two columns of one class are known for the same records, told by
    their number and two sums of the records' keys. One row comes to the driver."""
    known = [F.count(name).alias(f"{name}|n") for name in columns]
    known += [F.bit_xor(F.when(F.col(name).isNotNull(), F.col(key))).alias(f"{name}|{key}") for name in columns for key in ("id_a", "id_b")]
    found = records.agg(*known).first()
    numbers: dict[tuple, int] = {}
    return {name: numbers.setdefault(tuple(found[f"{name}|{part}"] for part in ("n", "id_a", "id_b")), len(numbers)) for name in columns}


def block_columns(numeric: Mapping[int, Pair], mixed: Mapping[int, Pair]) -> tuple[list[str], list[str]]:
    """The numbers and the categories of the pairs, in the order of the columns x0.. and g0.. of distinct_records."""
    numbers = list(dict.fromkeys([a for a, _ in [*numeric.values(), *mixed.values()]] + [b for _, b in numeric.values()]))
    return numbers, list(dict.fromkeys(b for _, b in mixed.values()))


def pair_sums(df: DataFrame, numeric: Mapping[int, Pair], mixed: Mapping[int, Pair], records: DataFrame | None = None) -> DataFrame:
    """Pairs (number, number) and (number, category) -> one row for each numeric pair (level null) and for each level of each mixed
    pair: (pair, level, n, s1, s2, s3, s4), over the records that have both.

    u is the midrank among these records less its mean, x the value less its mean, t the number of equal values squared less one.
    numeric: sums of u v, u u, v v (s4 = 0). mixed: sums of u, x, x x, t over the level.

    Which records a number is ranked on depends on the other variable only by its gaps, so variables with the same gaps share one
    ranking; without gaps each number is ranked once. The distinct records (records, if they are there already) and then the ranks of the
    distinct values are written below the checkpoint folder and read from there; the rest is lazy. A task holds a block of records and
    the sums of LEVELS levels."""
    pairs = {**numeric, **mixed}
    numbers, categories = block_columns(numeric, mixed)
    records = distinct_records(df, numbers, categories) if records is None else records
    cell = {**{("number", name): f"x{k}" for k, name in enumerate(numbers)}, **{("category", name): f"g{k}" for k, name in enumerate(categories)}}
    classes = presence_classes(records, list(cell.values()))
    partner = {pair: (cell["number", a], cell["number" if pair in numeric else "category", b]) for pair, (a, b) in pairs.items()}
    wanted: dict[str, list[int]] = {cell["number", name]: [] for name in numbers}
    for pair in pairs:
        sides = partner[pair] if pair in numeric else partner[pair][:1]
        for name, other in zip(sides, reversed(partner[pair])):
            if classes[other] not in wanted[name]:
                wanted[name].append(classes[other])
    slots = {(name, found): at for at, (name, found) in enumerate((name, found) for name, asked in wanted.items() for found in asked)}

    def slot(name: str, other: str) -> int:
        return slots[name, classes[other]]

    products = defaultdict(list)
    for pair in numeric:
        a, b = partner[pair]
        products[classes[a], classes[b]].append((pair, slot(a, b), slot(b, a)))
    by_level = defaultdict(list)
    for pair in mixed:
        a, g = partner[pair]
        by_level[categories.index(mixed[pair][1])].append((pair, slot(a, g)))
    of_class = {found: name for name, found in classes.items()}
    block = _ranked_block(records, wanted, of_class, len(categories))
    return _multiply(block, list(slots), list(products.values()), dict(by_level))


def category_counts(records: DataFrame, pairs: Mapping[int, Pair], categories: list[str]) -> DataFrame:
    """(pair, a, b, n) of pairs of categories from the distinct records."""
    cells = F.array(*[
        F.struct(F.lit(i).alias("pair"), F.col(f"g{categories.index(a)}").alias("a"), F.col(f"g{categories.index(b)}").alias("b")) for i, (a, b) in pairs.items()
    ])
    rows = records.select("weight", F.inline(cells)).where("a IS NOT NULL AND b IS NOT NULL")
    return rows.groupBy("pair", "a", "b").agg(F.sum("weight").alias("n"))


def _value_ranks(records: DataFrame, wanted: Mapping[str, list[int]], of_class: Mapping[int, str]) -> DataFrame:
    """(k, x, hot, cells) for each distinct value of number k: cells has all u, all x and all t of the
    classes it is wanted on, in their order. Every class is ranked in one sort of the values: running sums of a count for each."""
    width = max(map(len, wanted.values()))
    names = [f"n{j}" for j in range(width)]

    def weights(asked: list[int]) -> list[Column]:
        there = [F.when(F.col(of_class[found]).isNotNull(), F.col("weight")).otherwise(0) for found in asked]
        return [*there, *[F.lit(0).cast("long")] * (width - len(there))]

    cells = F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(name).alias("x"), F.col("weight").alias("n"), *[w.cast("long").alias(n) for n, w in zip(names, weights(asked))])
        for k, (name, asked) in enumerate(wanted.items())
    ])
    counts = records.select(F.inline(cells)).where("x IS NOT NULL").groupBy("k", "x").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names])
    # Always true; naming all counts keeps every branch on the one shuffle of them.
    bucketed = _bucketed(counts.where(F.greatest("n", *names) > 0), ["k"], "x", "n", None)
    whole = Window.partitionBy("k").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.partitionBy("k").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = bucketed.groupBy("k", "_bucket").agg(*[F.sum(n).alias(n) for n in ("n", *names)], *[F.sum(F.col(n) * F.col("x")).alias(f"{n}_x") for n in names])
    offsets = sums.select(
        "k", "_bucket", F.sum("n").over(whole).alias("_all"), *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in names],
        *[F.sum(n).over(whole).alias(f"{n}_total") for n in names], *[(F.sum(f"{n}_x").over(whole) / F.nullif(F.sum(n).over(whole), F.lit(0))).alias(f"{n}_mean") for n in names],
    )
    upto = Window.partitionBy("k", "_bucket").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = lookup(bucketed, offsets, ["k", "_bucket"]).withColumns({f"{n}_cum": F.col(f"{n}_before") + F.sum(n).over(upto) for n in names})

    def cell(n: str) -> tuple[Column, Column, Column]:
        ties = F.col(n).cast("double")
        midrank = F.col(f"{n}_cum") - (F.col(n) - 1) / F.lit(2.0)
        return midrank - (F.col(f"{n}_total") + 1) / F.lit(2.0), F.coalesce(F.col("x") - F.col(f"{n}_mean"), F.lit(0.0)), ties * ties - 1

    found = [part for parts in zip(*map(cell, names)) for part in parts]
    return ranked.select("k", "x", (F.col("n") >= F.col("_all") * HOT_SHARE).alias("hot"), F.array(*found).alias("cells"))


def _ranked_block(records: DataFrame, wanted: Mapping[str, list[int]], of_class: Mapping[int, str], categories: int) -> DataFrame:
    """(weight, g0.., p0.., c0..): each record with its levels, which classes it is in, and the ranks of number k for each class it
    is wanted on, as c<k>.

    Ranks of a number with few values are broadcast. Of one with many, those of frequent values are, and the others are
    joined: with a few such numbers the records go from one to the next, with more each number of a record is a row of its own."""
    values = _written(_value_ranks(records, wanted, of_class), "k")
    sizes = {row["k"]: row["n"] for row in values.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [k for k in range(len(wanted)) if sizes.get(k, 0) <= BROADCAST_VALUES]
    many = [k for k in range(len(wanted)) if k not in few]
    rows = records
    for k in range(len(wanted)):
        near = values.where((F.col("k") == k) & (F.lit(k in few) | F.col("hot"))).select(F.col("x").alias(f"x{k}"), F.col("cells").alias(f"c{k}"))
        rows = rows.join(F.broadcast(near), f"x{k}", "left")
    open_ = {k: F.when(F.col(f"c{k}").isNull(), F.col(f"x{k}")) for k in many}
    if len(many) <= JOINED:
        for k in many:
            far = values.where((F.col("k") == k) & ~F.col("hot")).select(F.col("x").alias("_far"), F.lit(0).alias("_zero"), F.col("cells").alias("_cells"))
            # A record with nothing to look up has no key; the salt keeps such records from meeting in one task.
            salted = rows.withColumn("_open", open_[k]).withColumn("_salt", F.when(F.col("_open").isNull(), 1 + F.pmod("id_a", F.lit(SALTS))).otherwise(0).cast("int"))
            found = salted.join(far, (F.col("_open") == F.col("_far")) & (F.col("_salt") == F.col("_zero")), "left")
            rows = found.withColumn(f"c{k}", F.coalesce(f"c{k}", "_cells")).drop("_open", "_salt", "_far", "_zero", "_cells")
    else:
        key = ["id_a", "id_b"]
        asked = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), x.alias("x")) for k, x in open_.items()]), lambda cell: cell["x"].isNotNull())
        long = rows.select(*key, F.inline(asked)).join(values.where("NOT hot").select("k", "x", "cells"), ["k", "x"])
        packed = long.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("k", "cells"))).alias("_far"))
        rows = rows.join(packed, key, "left").withColumns({f"c{k}": F.coalesce(f"c{k}", F.try_element_at("_far", F.lit(k))) for k in many})
    present = [F.col(of_class[found]).isNotNull().alias(f"p{found}") for found in of_class]
    return rows.select("weight", *[f"g{k}" for k in range(categories)], *present, *[f"c{k}" for k in range(len(wanted))])


def _multiply(block: DataFrame, slots: list[tuple[str, int]], products: list, by_level: dict) -> DataFrame:
    """The sums of pair_sums from a block; each task adds up its records before it gives rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uv, moments = [0.0] * len(products), np.zeros((2, len(slots)))
        levels: dict[tuple[int, str], np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, max(1, CELLS // len(slots))):
                part = batch.slice(start, max(1, CELLS // len(slots)))
                weight, here, values = _dense(part, slots)
                scaled = values["u"] * weight[:, None]
                moments += np.array([weight @ here, (scaled * values["u"]).sum(0)])
                for at, entries in enumerate(products):
                    _, left, right = (list(dict.fromkeys(e)) for e in zip(*entries))
                    uv[at] = uv[at] + scaled[:, left].T @ values["u"][:, right]
                _add_levels(levels, part, by_level, weight, here, values)
                if len(levels) > LEVELS:
                    yield _level_rows(levels, by_level)
                    levels = {}
        rows = []
        for total, entries in zip(uv, products):
            _, left, right = (list(dict.fromkeys(e)) for e in zip(*entries))
            if np.ndim(total):
                rows += [(p, None, moments[0, i], total[left.index(i), right.index(j)], moments[1, i], moments[1, j], 0.0) for p, i, j in entries if moments[0, i]]
        yield _as_batch(rows)
        yield _level_rows(levels, by_level)

    sums = block.mapInArrow(run, "pair int, level string, n double, s1 double, s2 double, s3 double, s4 double")
    return sums.groupBy("pair", "level").agg(F.sum("n").cast("long").alias("n"), *[F.sum(name).alias(name) for name in SUMS[1:]])


def _dense(batch: pa.RecordBatch, slots: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Weights, which cells are there, and the cells as records x slots with 0 for gaps."""
    here = np.zeros((batch.num_rows, len(slots)))
    values = {name: np.zeros((batch.num_rows, len(slots))) for name in ("u", "x", "t")}
    of_name = defaultdict(list)
    for at, (name, found) in enumerate(slots):
        of_name[name].append((at, found))
    for name, asked in of_name.items():
        cells = batch.column("c" + name[1:])
        rows = np.flatnonzero(cells.is_valid().to_numpy(zero_copy_only=False))
        if not len(rows):
            continue
        parts = cells.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), len(values), -1)
        for j, (at, found) in enumerate(asked):
            known = batch.column(f"p{found}").to_numpy(zero_copy_only=False)[rows]
            here[rows[known], at] = 1.0
            for part, table in enumerate(values.values()):
                table[rows[known], at] = parts[known, part, j]
    return batch.column("weight").to_numpy(zero_copy_only=False).astype(float), here, values


def _add_levels(levels: dict, batch: pa.RecordBatch, by_level: dict, weight: np.ndarray, here: np.ndarray, values: dict) -> None:
    for g, entries in by_level.items():
        column = batch.column(f"g{g}").dictionary_encode()
        codes = column.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        order = order[np.searchsorted(codes[order], 0) :]
        if not len(order):
            continue
        used = [at for _, at in entries]
        w, u, x, t = weight[order, None], *[values[name][np.ix_(order, used)] for name in ("u", "x", "t")]
        parts = np.stack((w * here[np.ix_(order, used)], w * u, w * x, w * x * x, w * t))
        heads = np.flatnonzero(np.diff(codes[order], prepend=-1))
        for code, total in zip(codes[order][heads], np.moveaxis(np.add.reduceat(parts, heads, axis=1), 1, 0)):
            key = g, column.dictionary[int(code)].as_py()
            levels[key] = levels[key] + total if key in levels else total


def _level_rows(levels: dict, by_level: dict) -> pa.RecordBatch:
    return _as_batch([(pair, level, *total[:, at]) for (g, level), total in levels.items() for at, (pair, _) in enumerate(by_level[g]) if total[0, at]])


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.string(), *[pa.float64()] * len(SUMS)]
    return pa.RecordBatch.from_arrays([pa.array([row[k] for row in rows], t) for k, t in enumerate(types)], names=["pair", "level", *SUMS])


def correlation() -> Column:
    """Spearman's rho from the sums of a numeric pair."""
    uv, uu, vv = (F.col(name) for name in ("s1", "s2", "s3"))
    rho = F.greatest(F.least(uv / F.sqrt(uu) / F.sqrt(vv), F.lit(1.0)), F.lit(-1.0))
    return F.when((uu > 0) & (vv > 0), rho)
