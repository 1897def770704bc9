"""Scan helpers."""

from __future__ import annotations

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Spread an input that scans as fewer partitions than the cluster has cores.

    A file that cannot be split (one Parquet row group, a gzip CSV) is read by
    a single task, and everything up to the next shuffle (joins against
    broadcast sides, per-row expressions, the map side of an aggregate) then
    runs in that one thread. When the scan has fewer partitions than the
    default parallelism, rows are hash-spread on all their columns: as
    deterministic under task retries as round-robin, without the sort Spark
    runs before a round-robin exchange. Identical rows share a target task,
    so a heavy run of exact copies spreads less well, but never worse than the
    single reading task it replaces. An input that already scans as at least
    one split per core is returned unchanged — no shuffle.
    """
    spark = df.sparkSession
    try:
        cores = spark.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except (PySparkAttributeError, PySparkNotImplementedError):  # no RDD view (a Connect session): leave the scan as is
        return df
    if splits < cores:
        return df.repartition(cores, *df.columns)
    return df


def input_bytes(spark, paths: str | list[str]) -> int:
    """Total size of the files under ``paths``, globs included; an absent path is an error."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    total = 0
    for p in [paths] if isinstance(paths, str) else paths:
        path = hadoop.Path(p)
        fs = path.getFileSystem(conf)
        found = list(fs.globStatus(path) or [])
        if not found:
            raise FileNotFoundError(p)
        total += sum(fs.getContentSummary(f.getPath()).getLength() for f in found)
    return total
