"""Rollups: additive measures at the grain of the reports.

At cluster scale a dashboard that scans the fact table once per chart costs
minutes per chart. The rollup groups the fact table once by the report keys
below and keeps only additive measures (counts, exact DECIMAL sums, min/max
date), so every report that does not group by product can be answered from it
with identical results. Its size is bounded by the key domains (months x
weekend/weekday x categories x regions x payment methods x buckets x flags),
not by the number of sales. Quarter follows from month, so it adds no rows;
the weekday enters only as weekend/weekday, all any report asks of it.

The product rollup does the same for the reports that group by product
(keys product_name, category, has_revenue); it is bounded by the number of
products.

Reports accept any frame that carries their keys: ``measures(df)`` turns the
fact table into per-row measures (a narrow projection) and passes a rollup
through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_type

ROLLUP_KEYS = [
    "year", "month", "quarter", "day_type", "category", "region", "payment_method",
    "revenue_bucket", "is_returned", "has_revenue",
]
PRODUCT_KEYS = ["product_name", "category", "has_revenue"]
MEASURES = ["n_rows", "n_ids", "n_revenue", "sum_revenue", "n_discount", "sum_discount", "sum_quantity"]


def row_measures(sales: DataFrame) -> DataFrame:
    """The fact table at its finest grain, as keys plus additive measures."""
    nr, disc = F.col("net_revenue"), F.col("discount_pct")
    return sales.select(
        "product_name",
        *[c for c in ROLLUP_KEYS if c not in ("day_type", "has_revenue")],
        day_type(F.col("weekday")).alias("day_type"),
        (nr > 0).alias("has_revenue"),
        F.lit(1).cast("long").alias("n_rows"),
        F.col("transaction_id").isNotNull().cast("long").alias("n_ids"),
        nr.isNotNull().cast("long").alias("n_revenue"),
        nr.alias("sum_revenue"),
        disc.isNotNull().cast("long").alias("n_discount"),
        disc.alias("sum_discount"),
        F.col("quantity").cast("long").alias("sum_quantity"),
        F.col("date").alias("min_date"),
        F.col("date").alias("max_date"),
    )


def sales_rollup(sales: DataFrame) -> DataFrame:
    """Group the fact table by ROLLUP_KEYS (partial + final hash aggregate)."""
    m = row_measures(sales)
    return m.groupBy(*ROLLUP_KEYS).agg(
        *[F.sum(c).alias(c) for c in MEASURES],
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
    )


def product_rollup(sales: DataFrame) -> DataFrame:
    """Group the fact table by PRODUCT_KEYS."""
    return row_measures(sales).groupBy(*PRODUCT_KEYS).agg(*[F.sum(c).alias(c) for c in MEASURES])


def measures(df: DataFrame) -> DataFrame:
    """A rollup as is; a fact table as per-row measures."""
    return df if "n_rows" in df.columns else row_measures(df)


# --- aggregate expressions over a measures frame ------------------------------
# Counts are sums of count measures; SUM over no rows is null where COUNT is 0.
def _count(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("long"))


def rows() -> Column:
    """COUNT(*)"""
    return _count("n_rows")


def ids() -> Column:
    """COUNT(transaction_id)"""
    return _count("n_ids")


def revenue() -> Column:
    """SUM(net_revenue) (exact DECIMAL; null when no value)"""
    return F.sum("sum_revenue")


def revenue_count() -> Column:
    """COUNT(net_revenue)"""
    return _count("n_revenue")


def discount() -> Column:
    """SUM(discount_pct)"""
    return F.sum("sum_discount")


def discount_count() -> Column:
    """COUNT(discount_pct)"""
    return _count("n_discount")


def returned() -> Column:
    """COUNT_IF(is_returned)"""
    return _count(F.when(F.col("is_returned"), F.col("n_rows")))


def flagged() -> Column:
    """COUNT(is_returned)"""
    return _count(F.when(F.col("is_returned").isNotNull(), F.col("n_rows")))


def rows_where(cond: Column) -> Column:
    """COUNT_IF(cond)"""
    return _count(F.when(cond, F.col("n_rows")))


def quantity() -> Column:
    """SUM(quantity)"""
    return F.sum("sum_quantity")


def with_revenue(m: DataFrame) -> DataFrame:
    """Rows with net_revenue > 0."""
    return m.filter(F.col("has_revenue"))
