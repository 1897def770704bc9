"""S3/S4/S5 — fact and summary tables on Parquet, and SQL over them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import COPIES, OK, RAW_DATE, STATUS
from ..operators.summaries import monthly_category_summary, product_summary, regional_summary
from ..schema import SALES, SALES_COLUMNS, SALES_PARTITION_COLUMNS
from ..session import released
from .versions import current, parts

# Partitions a rebalance before a partitioned write starts from: it has a few hundred keys,
# whatever number of partitions the shuffles before it need. AQE splits the large ones.
WRITE_PARTITIONS = 400

# Order of the rows of one month in a file.
CLUSTER_COLUMNS = ["category", "region"]

SUMMARY_TABLES = ("monthly_category_summary", "regional_summary", "product_summary")


def rebalanced_for_write(sales: DataFrame) -> DataFrame:
    """The fact rows as written: ``rebalance`` on the partition columns lets
    AQE size the write tasks. One hot month is split into several files of
    the advisory size and many small months share a task, so neither file
    count nor file size grows with skew."""
    return sales.select(*SALES_COLUMNS).hint("rebalance", WRITE_PARTITIONS, *SALES_PARTITION_COLUMNS)


def clustered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a task sorted by the partition columns, as a partitioned write does anyway, and then by category and
    region: pages and row groups of a file then hold few of these, and a filter on them skips the others."""
    return rows.sortWithinPartitions(*keys, *CLUSTER_COLUMNS)


def write_sales(sales: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: replace the fact table, partitioned by year/month."""
    with released(sales.sparkSession):
        clustered(rebalanced_for_write(sales), SALES_PARTITION_COLUMNS).write.mode(mode).partitionBy(*SALES_PARTITION_COLUMNS).parquet(path)


def write_staged(staged: DataFrame, path: str, mode: str = "overwrite") -> str:
    """S3 with the data-quality split: write a ``clean_with_status`` result
    partitioned by status, year, month in one job; returns the fact table's
    path (the ``dq_status=ok`` directory, whose year/month layout is that of
    ``write_sales``). Rejected rows land beside it, under their status."""
    keys = [STATUS, *SALES_PARTITION_COLUMNS]
    with released(staged.sparkSession):
        clustered(staged.hint("rebalance", WRITE_PARTITIONS, *keys), keys).write.mode(mode).partitionBy(*keys).parquet(path)
    return f"{path.rstrip('/')}/{STATUS}={OK}"


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "overwrite", partitions: int = 16, batch_size: int = 10000) -> None:
    """S3/S4 for a relational target: replace ``table`` over JDBC.

    Each of ``partitions`` tasks holds one connection and inserts in batches,
    which caps concurrent connections to the database. ``repartition`` (not
    ``coalesce``, which would also shrink the upstream stage to that many
    tasks) keeps the work before the write fully parallel. Needs the target's
    JDBC driver on the classpath (not shipped here, so untested offline).
    """
    (
        df.repartition(partitions)
        .write.mode(mode)
        .option("batchsize", batch_size)
        .option("truncate", mode == "overwrite")
        .jdbc(url, table, properties=properties or {})
    )


def read_sales_table(spark: SparkSession, path: str) -> DataFrame:
    """The fact table with its declared types (no partition type inference).

    The path of a staged table's ``dq_status=ok`` part reads the staged table and prunes to
    that part, so a run without any clean row reads as an empty table.
    """
    base, _, leaf = path.rstrip("/").rpartition("/")
    if leaf == f"{STATUS}={OK}":
        staged = T.StructType([*SALES.fields, T.StructField(STATUS, T.StringType())])
        return spark.read.schema(staged).parquet(base).filter(F.col(STATUS) == OK).select(*SALES_COLUMNS)
    return spark.read.schema(SALES).parquet(path).select(*SALES_COLUMNS)


def _read_parts(spark: SparkSession, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
    """One frame over several folders of one layout (Spark finds partition folders below one root only)."""
    return reduce(DataFrame.unionByName, (spark.read.schema(schema).parquet(p) for p in paths))


def read_fact_parts(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """The fact table of a set: the clean rows of its parts' staged tables."""
    staged = T.StructType([*SALES.fields, T.StructField(STATUS, T.StringType())])
    return _read_parts(spark, staged, [f"{f}/staged" for f in folders]).filter(F.col(STATUS) == OK).select(*SALES_COLUMNS)


def read_staged(spark: SparkSession, *paths: str) -> DataFrame:
    """The staged table, in one folder or several, with its declared types, also if it has no row."""
    more = [T.StructField(COPIES, T.LongType()), T.StructField(RAW_DATE, T.StringType()), T.StructField(STATUS, T.StringType())]
    return _read_parts(spark, T.StructType([*SALES.fields, *more]), paths)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replace one summary table (one row per group). AQE already
    coalesces the small final-aggregate output into few files; nothing forces
    a large summary through one task."""
    with released(df.sparkSession):
        df.write.mode(mode).parquet(path)


def write_summaries(sales: DataFrame, base: str, mode: str = "overwrite",
                    rollup: DataFrame | None = None, products: DataFrame | None = None) -> dict[str, str]:
    """The three summary tables, each replaced; returns name -> path.

    With written rollups, A1 and A2 come from the sales rollup and A3 from the
    product rollup (tables bounded by the key domains / product count), so
    the fact table is not scanned again.
    """
    builders = {
        "monthly_category_summary": lambda: monthly_category_summary(rollup if rollup is not None else sales),
        "regional_summary": lambda: regional_summary(rollup if rollup is not None else sales),
        "product_summary": lambda: product_summary(products if products is not None else sales),
    }
    out = {}
    for name, build in builders.items():
        p = f"{base.rstrip('/')}/{name}"
        write_table(build(), p, mode)
        out[name] = p
    return out


def register_views(spark: SparkSession, sales: DataFrame, rollup: DataFrame | None = None,
                   products: DataFrame | None = None) -> None:
    """Temp views for ad-hoc SQL: ``sales``, the summary tables (computed from
    the rollups when given, so querying them does not scan the fact table),
    and ``sales_rollup`` / ``product_rollup`` when given."""
    sales.createOrReplaceTempView("sales")
    monthly_category_summary(rollup if rollup is not None else sales).createOrReplaceTempView(
        "monthly_category_summary")
    regional_summary(rollup if rollup is not None else sales).createOrReplaceTempView("regional_summary")
    product_summary(products if products is not None else sales).createOrReplaceTempView("product_summary")
    if rollup is not None:
        rollup.createOrReplaceTempView("sales_rollup")
    if products is not None:
        products.createOrReplaceTempView("product_rollup")


def open_tables(spark: SparkSession, out_path: str, folder: str | None = None) -> dict[str, DataFrame]:
    """Register the current tables that ``run()`` wrote under ``out_path`` (or those in ``folder``) as temp views
    (``sales``, ``sales_rollup``, ``product_rollup`` and the three summary
    tables) and return them by name. All are of one set."""
    base = folder or current(spark, out_path)
    tables = {
        "sales": read_fact_parts(spark, parts(spark, base)),
        "sales_rollup": spark.read.parquet(f"{base}/sales_rollup"),
        "product_rollup": spark.read.parquet(f"{base}/product_rollup"),
        **{name: spark.read.parquet(f"{base}/{name}") for name in SUMMARY_TABLES},
    }
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def sql(spark: SparkSession, text: str, **args) -> DataFrame:
    """Ad-hoc SQL over the registered views; values are bound as named
    parameters (``:name``), never spliced into the text."""
    return spark.sql(text, args={k: F.lit(v) for k, v in args.items()} if args else None)
