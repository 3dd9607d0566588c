"""Target-distribution importance resampling over hashed n-grams, with segments deduplicated: line feeds cut texts
into lines, each distinct line's features are counted once for all its occurrences, and the n-grams that cross
lines are added for themselves."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import ALNUM, LOWER, map_batches, prepare, settle, table, text_bytes, word_spans

GRAMS, BUCKETS, LEAST_WORDS, PERCENT = 3, 10_000, 20, 5
#: A line with at least this share of all occurrences is known to every task: there are at most a thousand of them.
HOT_LINES = 1_000
#: Words longer than this are hashed by the zlib module one at a time.
_LONG = 64


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB8_8320), value >> 1)
    return value


_CRC = _crc_table()


def crc_extend(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of what each crc stands for, followed by data[start:end]."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, _LONG + 1), kind="stable")
    sizes, at = lengths[order], starts[order]
    state = ~crc[order]
    short = int(np.searchsorted(-sizes, -_LONG, "left")) if len(sizes) else 0
    for k in range(int(sizes[short]) if short < len(sizes) else 0):
        upto = int(np.searchsorted(-sizes, -k, "left"))
        part = state[short:upto]
        state[short:upto] = _CRC[(part ^ data[at[short:upto] + k]) & 0xFF] ^ (part >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = ~state
    for d in order[:short]:
        out[d] = zlib.crc32(data[starts[d] : ends[d]], int(crc[d]))
    return out


_SPACE = np.frombuffer(b" ", np.uint8)


def gram_buckets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, last: np.ndarray, crossing: np.ndarray | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner word, bucket) of the runs of 1 to GRAMS words that begin at each word and stay before `last`, the first
    word of the next text. With crossing, a line number for each word, only runs that reach into another line."""
    words = np.arange(len(starts))
    crc, kept = np.zeros(len(starts), np.uint32), words
    if crossing is not None:  # a word's runs can cross if the word GRAMS - 1 behind it is in another line or none
        behind = np.minimum(words + GRAMS - 1, last - 1)
        kept = np.flatnonzero(crossing[behind] != crossing)
        crc = crc[kept]
    owners, found = [], []
    for k in range(GRAMS):
        inside = kept + k < last[kept]
        kept, crc = kept[inside], crc[inside]
        if k:
            crc = crc_extend(crc, _SPACE, np.zeros(len(kept), np.int64), np.ones(len(kept), np.int64))
        crc = crc_extend(crc, data, starts[kept + k], ends[kept + k])
        wanted = slice(None) if crossing is None else crossing[kept + k] != crossing[kept]
        owners.append(kept[wanted])
        found.append((crc[wanted] % np.uint32(buckets)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(found)


def _packed(texts: np.ndarray, found: np.ndarray, n: int) -> list[bytes]:
    """The buckets of each text in order, as steps from one to the next: all low bytes, then all others, which are
    mostly zero and vanish when written."""
    order = np.lexsort((found, texts))
    texts, found = texts[order], found[order]
    ends = np.searchsorted(texts, np.arange(n + 1))
    steps = np.diff(found, prepend=0)
    heads = ends[:-1][ends[:-1] < ends[1:]]
    steps[heads] = found[heads]
    planes = [((steps >> (8 * k)) & 0xFF).astype(np.uint8).tobytes() for k in range(4)]
    return [b"".join(plane[a:b] for plane in planes) for a, b in zip(ends[:-1], ends[1:])]


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all rows behind each other, and the number of each row's."""
    rows, sizes = [], []
    for value in column.to_pylist():
        planes = np.frombuffer(value, np.uint8).reshape(4, -1).astype(np.int64)
        rows.append(np.cumsum(planes[0] | planes[1] << 8 | planes[2] << 16 | planes[3] << 24))
        sizes.append(planes.shape[1])
    return (np.concatenate(rows) if rows else np.zeros(0, np.int64)), np.array(sizes, np.int64)


def _features(texts: pa.Array, buckets: int, crossing: bool) -> tuple[np.ndarray, list[bytes]]:
    """For each text its number of words and its packed buckets; with crossing those of runs over several lines only."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, ALNUM)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    lines = np.searchsorted(np.flatnonzero(data == 10), starts) if crossing else None
    owner, found = gram_buckets(data, starts, ends, first[1:][text], lines, buckets)
    return counts, _packed(text[owner], found, len(counts))


def line_features(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """docs (text) -> key, n, features: each distinct line once, with its number of occurrences."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''").groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    keyed = lines.select("line", "n", F.unhex(F.md5("line")).alias("key"))
    return map_batches(keyed, lambda b: [b.column("key"), b.column("n"), pa.array(_features(b.column("line"), buckets, False)[1], pa.binary())], "key binary, n long, features binary")


def crossing_features(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_words, n_features (all of the text), features (those over several lines)."""

    def build(batch: pa.RecordBatch) -> list:
        counts, packed = _features(batch.column("text"), buckets, True)
        return [batch.column("doc_id"), counts, sum(np.maximum(counts - k, 0) for k in range(GRAMS)), pa.array(packed, pa.binary())]

    return map_batches(docs.select("doc_id", "text"), build, "doc_id long, n_words long, n_features long, features binary")


def _bucket_counts(rows: DataFrame, buckets: int) -> DataFrame:
    """rows (n, features) -> bucket, n: each task adds up its rows first and gives one row a bucket."""
    prepare(rows.sparkSession)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            found, sizes = _unpacked(batch.column("features"))
            np.add.at(total, found, np.repeat(np.asarray(batch.column("n")), sizes))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    return rows.select("n", "features").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) of source and target -> bucket, gain for every bucket: a thousand times the log of the bucket's
    smoothed share in the target over that in the source, rounded down."""
    totals = [counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar().cast("double") for counts in (source, target)]
    both = source.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(source.withColumnRenamed("n", "s"), "bucket", "left").join(
        target.withColumnRenamed("n", "t"), "bucket", "left"
    )
    s, t = (F.coalesce(F.col(name), F.lit(0)).cast("double") for name in ("s", "t"))
    ratio = ((t + 1) * (totals[0] + buckets)) / ((s + 1) * (totals[1] + buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def _weights(rows: DataFrame, keep: str, gains: np.ndarray) -> DataFrame:
    """rows (..., features) -> the kept columns and the sum of the gains of each row's features."""
    names = [part.split()[0] for part in keep.split(", ")]

    def weigh(batch: pa.RecordBatch) -> list:
        found, sizes = _unpacked(batch.column("features"))
        sums = np.concatenate(([0], np.cumsum(gains[found])))
        ends = np.cumsum(sizes)
        return [*[batch.column(name) for name in names], sums[ends] - sums[ends - sizes]]

    return map_batches(rows.select(*names, "features"), weigh, f"{keep}, weight long")


def importance_weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """docs (doc_id, text, ...), target (text, ...) -> doc_id, n_words, n_features, weight.

    Words are runs of letters and digits, A-Z lower-cased; features all runs of one to three consecutive words, joined
    by one space, hashed by crc32 to `buckets`. A weight adds up the gains (bucket_gains) of all features of a text, each
    as often as it occurs. Rows that share a doc_id, null among them, count as one document with the features of all its rows; null and
    empty texts have none and weigh 0; other columns are ignored; an empty table gives an empty result.

    1. The distinct lines of all texts, grouped by their bytes, are turned to buckets once and written with their number of
       occurrences; so are the runs over several lines of each row. Bucket counts are those times the occurrences.
    2. Gains are one number for each bucket, the only thing that passes the driver.
    3. Each distinct line is weighed once; rows meet the weights of their lines by the line's 128-bit MD5. Lines with a
       thousandth of all occurrences, at most a thousand lines, are broadcast, so no key of the join has more."""
    plain = docs.select("doc_id", "text")
    lines, crosses = settle(line_features(plain, buckets)), settle(crossing_features(plain, buckets))
    wanted = line_features(target, buckets).select("n", "features").union(crossing_features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets).select(F.lit(1), "features"))
    source = lines.select("n", "features").union(crosses.select(F.lit(1), "features"))
    found = bucket_gains(settle(_bucket_counts(source, buckets)), settle(_bucket_counts(wanted, buckets)), buckets).toPandas()
    gains = np.zeros(buckets, np.int64)
    gains[found["bucket"].to_numpy()] = found["gain"].to_numpy()

    weighed = settle(_weights(lines, "key binary, n long", gains))
    hot = weighed.where(F.col("n") * HOT_LINES >= weighed.agg(F.sum("n")).scalar()).select("key", F.col("weight").alias("hot"))
    places = plain.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''").select("doc_id", F.unhex(F.md5("line")).alias("key"))
    places = places.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("k")).join(F.broadcast(hot), "key", "left")
    # Rows that know their weight already look for a key that no line has, and so spread over all tasks.
    elsewhere = F.encode(F.concat(F.lit("-"), F.xxhash64("doc_id", "key").cast("string")), "UTF-8")
    places = places.withColumn("key", F.when(F.col("hot").isNull(), F.col("key")).otherwise(elsewhere)).join(weighed.select("key", "weight"), "key", "left")
    parts = places.select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_features"), (F.col("k") * F.coalesce("hot", "weight")).alias("weight"))
    parts = parts.union(_weights(crosses, "doc_id long, n_words long, n_features long", gains))
    return parts.groupBy("doc_id").agg(F.sum("n_words").alias("n_words"), F.sum("n_features").alias("n_features"), F.sum("weight").alias("weight"))


def drawn(weights: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = 42) -> DataFrame:
    """(doc_id, n_words, weight, ...) -> the same with score and rank: the weight and a Gumbel number drawn from seed and
    doc_id, times a thousand and rounded down. Of the N rows with `least_words` words or more, the floor(percent * N / 100) with the
    highest scores get their place, 1, 2, 3 and so on, ties by doc_id; the others null. Taking the highest sums of log weight
    and Gumbel number draws without replacement in proportion to the weights.

    Rows are dealt by score into ranges that are sorted one by one; a place is the place in its range behind the
    rows of all ranges before it, so no task sorts them all."""
    spark = weights.sparkSession
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(share))).cast("long")
    scored = settle(weights.withColumn("score", F.col("weight") + noise).withColumn("_able", F.col("n_words") >= least_words))
    order = [F.col("_able").desc(), F.col("score").desc(), F.col("doc_id").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = settle(scored.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.where("_able").groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each range: as many as the session has shuffle partitions.
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    wanted = sizes.agg(F.floor(F.coalesce(F.sum("_n"), F.lit(0)) * percent / 100)).scalar()
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    placed = dealt.join(F.broadcast(offsets), "_part", "left").withColumn("_place", place)
    return placed.withColumn("rank", F.when(F.col("_able") & (F.col("_place") <= wanted), F.col("_place")).cast("long")).drop("_able", "_part", "_before", "_place")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """docs that were drawn towards the target, all columns kept."""
    chosen = drawn(importance_weights(docs, target, buckets), percent, least_words, seed).where("rank IS NOT NULL").select("doc_id")
    return docs.join(chosen, "doc_id", "left_semi")


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = importance_weights(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn(weights).select("doc_id", "n_features", "weight", "score", "rank")


#: crc32 of a text from its bytes, by the table of its 256 steps.
_CRC_SQL = """
k AS (SELECT list_transform(range(0, 256), lambda b: list_reduce(list_prepend(cast(b AS bigint), range(0, 8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
x AS (SELECT DISTINCT f, hex(encode(f)) AS x FROM g),
y AS (SELECT f, list_transform(range(0, len(x) // 2), lambda i: cast('0x' || substr(x, cast(2 * i + 1 AS bigint), 2) AS bigint)) AS bytes FROM x),
z AS (SELECT f, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM y, k)"""
OP11_SQL = rf"""
WITH a AS (SELECT true AS source, doc_id, text FROM documents UNION ALL SELECT false, null, text FROM benchmark),
w AS (SELECT source, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM a),
g AS (SELECT source, doc_id, unnest(list_concat(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])),
  list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS f FROM w),{_CRC_SQL},
n AS (SELECT source, doc_id, bucket, count(*) AS n FROM g JOIN z USING (f) GROUP BY ALL),
c AS (SELECT bucket, coalesce(sum(n) FILTER (source), 0) AS s, coalesce(sum(n) FILTER (NOT source), 0) AS t FROM n GROUP BY bucket),
o AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM c),
i AS (SELECT bucket, floor(1000 * ln(((cast(t AS double) + 1) * (cast(all_s AS double) + 10000)) / ((cast(s AS double) + 1) * (cast(all_t AS double) + 10000)))) AS gain FROM c, o),
d AS (SELECT doc_id, sum(len(ws)) AS n_words, sum(len(ws) + greatest(len(ws) - 1, 0) + greatest(len(ws) - 2, 0)) AS n_features FROM w WHERE source GROUP BY doc_id),
v AS (SELECT doc_id, sum(n * gain) AS weight FROM n JOIN i USING (bucket) WHERE source GROUP BY doc_id),
r AS (SELECT d.doc_id, n_words, n_features, cast(coalesce(weight, 0) AS bigint) AS weight, cast('0x' || sha256('42:' || coalesce(cast(d.doc_id AS varchar), ''))[1:8] AS bigint) AS h
  FROM d LEFT JOIN v ON v.doc_id IS NOT DISTINCT FROM d.doc_id),
q AS (SELECT *, weight + cast(floor(-1000 * ln(-ln((cast(h AS double) + cast(0.5 AS double)) / cast(4294967296 AS double)))) AS bigint) AS score FROM r),
p AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () * 5 // 100 AS wanted FROM q)
SELECT doc_id, cast(n_features AS bigint) AS n_features, weight, score, CASE WHEN n_words >= 20 AND place <= wanted THEN place END AS rank FROM p
"""

QUERIES, ORACLES = {"op11_resample": op11_resample}, {"op11_resample": OP11_SQL}
