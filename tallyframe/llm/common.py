"""What the corpus operators share: reading, settling intermediate tables, Arrow batches and word tables."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.plans.session import checkpoint_dir

#: Arrow batches end at whichever comes first; numpy works on about forty bytes for each byte of text.
BATCH_ROWS, BATCH_BYTES = 1_000, 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Sizes of Arrow batches, and this package for the executors, once for each context."""
    context = spark.sparkContext
    if not getattr(context, "_tallyframe_sent", False):
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="tallyframe-")) / "tallyframe_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._tallyframe_sent = True
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def settle(df: DataFrame) -> DataFrame:
    """The rows written as a table to the shared folder of spark.checkpoint.dir and read again: lineage ends
    here, a lost executor costs no recomputation, and the planner knows the table's size. Tables stay until
    the folder is cleaned, like any checkpoint."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with those of its columns renamed that are called like one of names, whatever the case, and a function that
    gives a result its columns and their names back."""
    taken, moved = {*names, *(c.lower() for c in docs.columns)}, []
    for column in docs.columns:
        new = column
        while new.lower() in names or (new != column and new.lower() in taken):
            new += "_"
        taken.add(new.lower())
        moved.append(new)
    return docs.toDF(*moved), lambda out: out.select(*(f"`{c}`" for c in moved)).toDF(*docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """docs with a key of its own for each row, _row; written, so that every reader sees the same keys."""
    return settle(docs.withColumn("_row", F.monotonically_increasing_id()))


def first_rows(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """numbered rows, and (_row, _group) -> one row of each group: that of the smallest doc_id, one without an id only
    if none has one. Rows of one id go by a hash of their plain columns, so the choice does not hang on the reading."""
    plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType) and f.name != "_row"]
    ranked = rows.select("_row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*plain).alias("hash"), "_row").alias("rank"))
    first = ranked.join(groups, "_row").groupBy("_group").agg(F.min("rank").alias("rank")).select("rank._row")
    return rows.join(first, "_row", "left_semi").drop("_row")


def release(spark: SparkSession) -> None:
    """Lets the driver forget plans that are done with, so that their shuffle files go at once and not when it
    happens to collect its garbage. Python's references go in the first round, what they held in the second."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def _slices(batch: pa.RecordBatch, size: str | None) -> Iterator[pa.RecordBatch]:
    """The batch, or pieces with at most BATCH_BYTES by the column size, unless a single row has more."""
    if size is None:
        yield batch
        return
    ends, start = np.cumsum(batch.column(size).to_numpy().astype(np.int64)), 0
    while start < len(ends):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BATCH_BYTES, "right"))
        yield batch.slice(start, max(stop - start, 1))
        start = max(stop, start + 1)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | list], schema: str, size: str | None = None) -> DataFrame:
    """function over each Arrow batch; schema names the columns it returns, size a column with the bytes each row has when
    it is unpacked: small rows may stand for long texts."""
    prepare(df.sparkSession)
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _slices(batch, size) if batch.num_rows else ():
                columns = function(piece)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(schema))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a batch behind each other and len + 1 offsets; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_table() -> np.ndarray:
    table_ = np.arange(256, dtype=np.uint8)
    table_[65:91] += 32
    return table_


def mask(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for first, last in ranges:
        found[first : last + 1] = True
    return found


LOWER = lower_table()
#: A word of letters and digits: anything outside 00-2F, 3A-60 and 7B-7F after lower-casing A-Z.
ALNUM = ~mask((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: A word between white space: anything but space and 09-0D.
SPACED = ~mask((0x20, 0x20), (0x09, 0x0D))

_BYTE = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E37_79B9_7F4A_7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58_476D_1CE4_E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D0_49BB_1331_11EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n of the base and of its inverse modulo 2^64, kept for the next batch."""
    if len(_POWERS[0]) < n + 1:
        size = max(n + 1, 1 << 20)
        for at, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[at] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums over the first i bytes, from which range_hashes() takes the hash of any range."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the batch's bytes, and for each text the number of words before it."""
    inside = word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside))
    after = np.concatenate((inside, [False]))
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hashes(prefix_hashes(data), starts, ends)
