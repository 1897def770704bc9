"""Adding a batch of new files to a versioned set, at the cost of the batch.

The batch is cleaned like any input. Of its transaction ids those that the set already has, in any status, are late copies:
T1 keeps the first, so they only count. What remains is written as one more part of the fact table, and
the measures of the rollups, all additive, are those of the old rollup rows and of the batch, added up. Of the sales rollup
only the months that the batch touches are added up again. The result is a new version; it equals a
run over all files in the order in which the batches came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import COPIES, KEY, clean_with_status, status_counts
from ..operators.rollup import MEASURES, PRODUCT_KEYS, ROLLUP_KEYS, product_rollup, sales_rollup
from ..session import sized_for
from ..sources.csv import CSV_ORDER_COLUMNS, read_sales
from ..sources.scan import input_bytes, spread
from ..sources.tables import read_fact_parts, read_staged, write_staged, write_table
from ..sources.versions import PARTS, commit, new_version, parts, version_of, write_json
from .pipeline import RunResult, write_reports

#: In a set's folder: how many late copies its batches brought, one row a batch.
LATE = "late_copies"
#: In a set's ``batch`` table: whether the set before had the row's id.
IS_LATE = "is_late"
MONTH = ["year", "month"]


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rollup rows of both, added up by ``keys`` (null keys alike)."""
    dates = [f("min_date" if f is F.min else "max_date").alias("min_date" if f is F.min else "max_date") for f in (F.min, F.max)] if "min_date" in old.columns else []
    return old.unionByName(new).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in MEASURES], *dates)


def merged_months(old: DataFrame, new: DataFrame) -> DataFrame:
    """The sales rollup with a batch's rollup ``new``; rows of months that the batch hasn't stay as they are."""
    touched = new.select(F.col("year").alias("_y"), F.col("month").alias("_m")).distinct()
    same = F.col("year").eqNullSafe(F.col("_y")) & F.col("month").eqNullSafe(F.col("_m"))
    rest = old.join(touched, same, "left_anti")
    again = old.join(touched, same, "left_semi")
    columns = [*ROLLUP_KEYS, *MEASURES, "min_date", "max_date"]
    types = {f.name: f.dataType for f in old.schema.fields}
    back = lambda df: df.select(*[F.col(c).cast(types[c]).alias(c) for c in columns])  # noqa: E731 (a sum widens its decimal)
    return back(rest).unionByName(back(merged(back(again), back(new), ROLLUP_KEYS)))


def with_late(cleaned: DataFrame, known: DataFrame) -> DataFrame:
    """``cleaned``, one row an id, with IS_LATE: whether the id is among ``known`` (a null id is one id). Late rows keep their COPIES only.

    The join is by the plain key, by which T1 has dealt out its rows already, so only the known ids are shuffled; a null id is looked up apart.
    """
    ids = known.select(F.col(KEY).alias("_known")).where("_known IS NOT NULL").distinct()
    null_known = F.lit(not known.where(F.col(KEY).isNull()).isEmpty())
    late = F.when(F.col(KEY).isNull(), null_known).otherwise(F.col("_known").isNotNull())
    rows = cleaned.join(ids.hint("merge"), F.col(KEY) == F.col("_known"), "left").withColumn(IS_LATE, late)
    return rows.select(*[F.col(c) if c == COPIES else F.when(~F.col(IS_LATE), F.col(c)).alias(c) for c in cleaned.columns], IS_LATE)


def refresh(spark: SparkSession, out_path: str, raw_path: str | list[str], multi_line: bool = False, quoted_breaks: bool = False) -> RunResult:
    """Adds the CSV files of ``raw_path`` to the current set of ``out_path``, which must be versioned.

    The batch is cleaned once and written, its late rows without their values; the set's ids are read once, as a column. A batch without any new row gives a version
    with the same tables and more late copies.
    """
    number, old = version_of(spark, out_path)
    if not number:
        raise ValueError(f"{out_path}: no committed set to refresh")
    folder, folders = new_version(spark, out_path), parts(spark, old)
    batch_path = f"{folder}/batch"
    with sized_for(spark, input_bytes(spark, raw_path)):
        raw = spread(read_sales(spark, raw_path, multi_line=multi_line, quoted_breaks=quoted_breaks))
        cleaned = with_late(clean_with_status(raw, CSV_ORDER_COLUMNS), read_staged(spark, *[f"{f}/staged" for f in folders]))
        write_table(cleaned, batch_path)  # read back whole: no need of a shuffle to months, which only the new rows get
        batch = spark.read.schema(cleaned.schema).parquet(batch_path)
        write_staged(batch.where(~F.col(IS_LATE)).drop(IS_LATE), f"{folder}/staged")
    before = spark.read.parquet(f"{old}/{LATE}") if len(folders) > 1 else None
    counted = batch.where(IS_LATE).agg(F.coalesce(F.sum(COPIES), F.lit(0)).cast("long").alias("n"))
    write_table(counted if before is None else before.unionByName(counted), f"{folder}/{LATE}")
    new = read_fact_parts(spark, [folder])
    rollup, products, paths = write_reports(
        merged_months(spark.read.parquet(f"{old}/sales_rollup"), sales_rollup(new)),
        merged_products(spark.read.parquet(f"{old}/product_rollup"), product_rollup(new)), folder)
    names = [f.rpartition("/")[2] for f in (*folders, folder)]
    write_json(spark, f"{folder}/{PARTS}", names)
    commit(spark, out_path, folder)
    sales = read_fact_parts(spark, [*folders, folder])
    return RunResult(sales, f"{folder}/staged", paths, set_counts(spark, folder), rollup, f"{folder}/sales_rollup", products, f"{folder}/product_rollup", folder)


def merged_products(old: DataFrame, new: DataFrame) -> DataFrame:
    """The product rollup with a batch's."""
    types = {f.name: f.dataType for f in old.schema.fields}
    both = merged(old, new.select(*[F.col(c).cast(types[c]).alias(c) for c in old.columns]), PRODUCT_KEYS)
    return both.select(*[F.col(c).cast(types[c]).alias(c) for c in old.columns])


def set_counts(spark: SparkSession, folder: str) -> DataFrame:
    """T11 of a set: the counters of its staged parts, late copies among the duplicates."""
    folders = parts(spark, folder)
    counts = status_counts(read_staged(spark, *[f"{f}/staged" for f in folders]))
    if len(folders) == 1:
        return counts
    late = spark.read.parquet(f"{folder}/{LATE}").select(F.col("n").alias("raw_rows"), F.col("n").alias("duplicates"))
    both = counts.unionByName(late, allowMissingColumns=True)
    return both.agg(*[F.sum(c).alias(c) for c in counts.columns])
