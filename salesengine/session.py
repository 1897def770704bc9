"""Session helpers: a local session for tests/bench, and the shared work folder."""

from __future__ import annotations

import contextlib
import math
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "salesengine", **conf: str) -> SparkSession:
    """A local[N] session configured like the cluster one (AQE on, UI off)."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(conf.pop("shuffle_partitions", 8)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    local-mode session without one gets a fresh temporary folder; on a cluster
    the setting is required, because a machine-local folder is not shared.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="salesengine-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared work folder for one written table."""
    return f"{work_dir(spark)}/salesengine/{name}-{uuid.uuid4().hex[:12]}"


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
#: A shuffle block (one map task's rows for one reducer) should not be smaller than this.
LEAST_BLOCK = 128 << 10
#: Bytes of text rows in a partition of a shuffle that sorts them: it fits the memory of a task, whatever the session's number of partitions.
SORTED_PARTITION = 32 << 20


def shuffle_shape(input_bytes: int, least_split: int = 128 << 20, per_partition: int = 1 << 30) -> tuple[int, int]:
    """(bytes of a scan split, number of shuffle partitions) for an input of a full-row shuffle.

    Blocks number splits x partitions. With splits and partitions of about
    ``sqrt(input * LEAST_BLOCK)`` bytes each they stay at LEAST_BLOCK however large the input
    (100 TB: 3.7 GB each, about 30,000 x 30,000); a small input keeps the usual sizes.
    """
    even = math.isqrt(input_bytes * LEAST_BLOCK)
    split, part = max(least_split, even), max(per_partition, even)
    return split, max(1, math.ceil(input_bytes / part))


#: Makes Spark remove a query's shuffle files when it ends, not when the driver's garbage collector finds them unused.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes made inside are removed once each has ended: a job of several writes, each of which reads
    what the one before wrote, then holds the files of one write at a time."""
    old = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if old is None else spark.conf.set(RELEASE, old)


@contextlib.contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Scan splits and shuffle partitions sized for ``input_bytes``; the session's own settings
    are never lowered and are restored at the end."""
    split, partitions = shuffle_shape(input_bytes, per_partition=SORTED_PARTITION)
    old = {k: spark.conf.get(k, None) for k in (INITIAL_PARTITIONS, SPLIT_BYTES)}
    have = max(int(old[INITIAL_PARTITIONS] or 0), int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(INITIAL_PARTITIONS, str(max(have, partitions, spark.sparkContext.defaultParallelism)))
    if split > 128 << 20:
        spark.conf.set(SPLIT_BYTES, str(split))
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sized_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session with the settings of ``spark`` and shuffle partitions for ``input_bytes`` of text rows, for frames that run later.

    ``spark`` itself where its own number of partitions is enough.
    """
    partitions = shuffle_shape(input_bytes, per_partition=SORTED_PARTITION)[1]
    have = max(int(spark.conf.get(INITIAL_PARTITIONS, None) or 0), int(spark.conf.get("spark.sql.shuffle.partitions")))
    if partitions <= have:
        return spark
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.get(k, None) != v and own.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set(INITIAL_PARTITIONS, str(partitions))
    return own
