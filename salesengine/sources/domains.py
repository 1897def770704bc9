"""Domain dictionary: the distinct values of the report keys, kept beside the rollup.

The job that writes a rollup writes its dictionary too, as one small file. A plan whose columns depend
on the values (D13), and a list to choose from (D6), then need no Spark job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import read_json, write_json

DOMAINS = "domains.json"
COLUMNS = ("category", "region", "payment_method", "revenue_bucket")


def cap(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.pivotMaxValues"))


def write_domains(rollup: DataFrame, path: str, columns: tuple[str, ...] = COLUMNS) -> None:
    """Sorted values of each column, without null. A column of more than ``spark.sql.pivotMaxValues`` values is
    left out, as no plan may have that many columns; so at most that many values and one reach the driver a column."""
    spark = rollup.sparkSession
    most = cap(spark)
    pairs = rollup.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")).select("p.*")
    found = pairs.where("value IS NOT NULL").distinct()
    sizes = {r.name: r.n for r in found.groupBy("name").agg(F.count("*").alias("n")).collect()}
    values: dict[str, list[str]] = {c: [] for c in columns if sizes.get(c, 0) <= most}
    for r in found.where(F.col("name").isin(list(values))).collect():
        values[r.name].append(r.value)
    write_json(spark, path, {c: sorted(v) for c, v in values.items()})


def read_domains(spark: SparkSession, path: str) -> dict[str, list[str]] | None:
    """Column -> sorted values; None if no dictionary was written."""
    return read_json(spark, path)
