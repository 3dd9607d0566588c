"""Incremental record scans. Every row-local operator takes the streaming frame as it takes a batch one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.flatten import flatten_records
from tallyframe.sources.contract import Contract
from tallyframe.sources.records import parse_records, valid_records


def stream_records(spark: SparkSession, path: str, one_per_line: bool = False, files_per_batch: int = 1000) -> DataFrame:
    """Record documents as they arrive below path, parsed like a batch scan."""
    raw = (
        spark.readStream.schema("value string").option("pathGlobFilter", "*" if one_per_line else "*.json").option("wholetext", not one_per_line)
        .option("maxFilesPerTrigger", files_per_batch).format("text").load(path)
    )
    named = raw.select(F.col("_metadata.file_name").alias("file_name"), "value")
    return parse_records(named, file_name=None if one_per_line else "file_name")


def stream_wide(records: DataFrame, contract: Contract, path: str, checkpoint: str):
    """Append wide rows of arriving records to a Parquet table, once per record file."""
    wide = flatten_records(valid_records(records), contract)
    return (
        wide.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
