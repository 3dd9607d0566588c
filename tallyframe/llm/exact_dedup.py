"""Exact dedup: group by a 128-bit hash of the content, compare the bytes in each group, keep the smallest id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import first_rows, numbered, set_aside, settle, table
from tallyframe.llm.links import hot_join

SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def content_hash(text: Column) -> Column:
    """128 bits as binary."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, keep_id, group_size, kept, text_sha256; one row for each row read.

    Texts are equal when identical after each white-space run became one space; null counts as empty. Groups
    form on (128-bit hash, text), so Spark compares the bytes of texts whose hashes agree and a collision ends
    up in two groups; copies collapse on the map side, so a text that a third of all rows share is one row a
    task. Rows find their group again by the hash and the text's SHA-256, without the text; the rows of a frequent
    text scatter over salts there. The groups, without their texts, are written first. Two texts that
    agree in both hashes raise an error instead of merging. A row repeated with the same doc_id counts in group_size,
    and each of its rows is kept if its id is. A null doc_id is kept only if no row of its group has an id.
    An empty table gives an empty result; other columns are ignored."""
    text = normalised(F.col("text"))
    keyed = docs.select(F.col("doc_id"), text.alias("body"))
    keyed = keyed.select("doc_id", hash_of(F.col("body")).alias("hash"), F.sha2("body", 256).alias("text_sha256"), "body")
    texts = keyed.groupBy("hash", "text_sha256", "body").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = texts.groupBy("hash", "text_sha256").agg(
        F.count(F.lit(1)).alias("n_texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    groups = settle(groups.select(
        "hash", "text_sha256", "keep_id", F.when(F.col("n_texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts agree in both hashes"))).alias("group_size"),
    ))
    sizes = groups.select("hash", "text_sha256", F.col("group_size").alias("size"))
    return hot_join(keyed.drop("body"), groups, ["hash", "text_sha256"], sizes, "doc_id").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """docs without the rows whose text another row with a smaller doc_id has, nor rows repeating a doc_id, nor rows
    without one: later stages could not tell those apart."""
    docs, restored = set_aside(docs, "_id")
    kept = exact_groups(docs.select("doc_id", "text"), hash_of).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return restored(docs.join(kept, F.col("doc_id") == F.col("_id"), "left_semi").dropDuplicates(["doc_id"]))


def drop_repeats(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """docs with one row of each text: that of the smallest doc_id, one without an id only if no other has one. No text
    is lost: rows without an id and different texts under one id stay. Rows are told apart by written numbers. All
    columns stay, whatever their names."""
    docs, restored = set_aside(docs, "_row")
    rows = numbered(docs)
    groups = exact_groups(rows.select(F.col("_row").alias("doc_id"), "text"), hash_of)
    return restored(first_rows(rows, groups.select(F.col("doc_id").alias("_row"), F.col("keep_id").alias("_group"))))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256 FROM n JOIN g USING (body)
"""

QUERIES = {"op2_exact_dedup": op2_exact_dedup}
ORACLES = {"op2_exact_dedup": OP2_SQL}
