"""The corpus pipeline: language ID, exact dedup, near-dedup, benchmark decontamination, BPE encoding.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns the columns of documents;
the last one adds the token ids. run() writes each stage as Parquet to the shared folder and reads it again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.bpe import encode
from tallyframe.llm.common import settle, table
from tallyframe.llm.decontaminate import remove_leaks
from tallyframe.llm.exact_dedup import drop_repeats
from tallyframe.llm.language import keep_known
from tallyframe.llm.near_dedup import drop_near_copies


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeats(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs).withColumn("n_tokens", F.coalesce(F.size("tokens"), F.lit(0)).cast("long"))


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("BPE encoding", encoding_stage),
]
#: SQL can't express the automata and models of the stages; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


QUERIES, ORACLES = {"pipeline": pipeline}, {}
