"""Reading the given tables and cutting lineage in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local master without the setting (tests)
    falls back to a temporary folder of this machine; elsewhere the absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.gettempdir() + "/llm-checkpoints"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: computed once, no lineage."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def no_clash(docs: DataFrame, results: list[str]) -> None:
    """An error if a column of ``docs`` has the name of a result (names are told apart without regard to case)."""
    taken = {c.lower() for c in docs.columns}
    clash = [c for c in results if c.lower() in taken]
    if clash:
        raise ValueError(f"columns named like results, to be dropped or renamed first: {', '.join(clash)}")


def map_rows(docs: DataFrame, run, schema: T.StructType) -> DataFrame:
    """``docs.mapInArrow(run, schema)`` for any column names, which Arrow functions otherwise don't take."""
    names = [f"c{i}" for i in range(len(schema))]

    def renamed(batches):
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    plain = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names, schema.fields)])
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(renamed, plain).toDF(*schema.names)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def split_of(key, n: int, keep: int):
    """True where crc32 of the key's decimal text leaves the remainder ``keep`` modulo ``n``.

    A null key counts as the empty text.
    """
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n == keep
