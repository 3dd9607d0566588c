"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Adaptive execution does the sizing: partitions are coalesced or split by measured bytes."""
    for name, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }.items():
        spark.conf.set(name, value)
    return spark


def spread(scan: DataFrame) -> DataFrame:
    """Row-heavy work (JSON, regular expressions, pair expansion) over a scan with fewer splits than
    cores: share the rows out first. With as many splits as cores, as on any large input, nothing changes.
    For plain scans only: counting the splits of anything that shuffles would run it."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a local master, as in tests, may do without: a folder of
    one machine is of no use to executors on another."""
    context = spark.sparkContext
    chosen = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not chosen:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        chosen = tempfile.mkdtemp(prefix="tallyframe-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(chosen)
    return chosen
