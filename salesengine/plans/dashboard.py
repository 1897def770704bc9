"""D1-D13 — the datasets behind each dashboard chart and table.

Money is rounded to whole units and percentages to 1 decimal. The two local
post-steps of a dashboard (the MM/YYYY label and the region x category pivot)
are part of the plan, so nothing is finished on the driver.

Every dataset takes the fact table or a rollup (the sales rollup, or for
D7-D9, which group by product, the product rollup) and gives the same result
from either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import mean_money, mean_percent, percent, round_money
from ..operators.rollup import (
    discount,
    discount_count,
    ids,
    measures,
    quantity,
    returned,
    revenue,
    revenue_count,
    rows,
    with_revenue,
)


def kpis(sales: DataFrame) -> DataFrame:
    """Orders, revenue, mean order value, return rate over all rows."""
    return measures(sales).agg(
        ids().alias("total_orders"),
        round_money(revenue(), 0).alias("total_revenue"),
        mean_money(revenue(), revenue_count(), 0).alias("avg_order_value"),
        percent(returned(), rows(), 1).alias("return_rate"),
    )


def monthly(sales: DataFrame) -> DataFrame:
    """Revenue and orders per month with an ``MM/YYYY`` label."""
    return (
        with_revenue(measures(sales))
        .groupBy("year", "month")
        .agg(round_money(revenue(), 0).alias("revenue"), rows().alias("orders"))
        .withColumn("period", F.concat(F.lpad(F.col("month").cast("string"), 2, "0"), F.lit("/"),
                                       F.col("year").cast("string")))
        .orderBy("year", "month")
    )


def category_revenue(sales: DataFrame) -> DataFrame:
    """D3: revenue per category, descending."""
    return (
        with_revenue(measures(sales))
        .groupBy("category")
        .agg(round_money(revenue(), 0).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc_nulls_last("category"))
    )


def payment_counts(sales: DataFrame) -> DataFrame:
    """Transactions per payment method, descending."""
    return (
        measures(sales)
        .groupBy("payment_method")
        .agg(rows().alias("txns"))
        .orderBy(F.desc("txns"), F.asc_nulls_last("payment_method"))
    )


def day_type_split(sales: DataFrame) -> DataFrame:
    """Weekday vs weekend orders and revenue."""
    return (
        with_revenue(measures(sales))
        .groupBy("day_type")
        .agg(rows().alias("orders"), round_money(revenue(), 0).alias("revenue"))
    )


def category_list(sales: DataFrame) -> DataFrame:
    """Sorted distinct categories (a distributed distinct, not a collect)."""
    return sales.select("category").distinct().orderBy(F.asc_nulls_last("category"))


def top_products(sales: DataFrame, category: str | None = None, k: int = 15) -> DataFrame:
    """Top-k products by revenue, optionally within one category.

    The category is compared as a bound value (pushed to the scan as an
    equality filter), never spliced into SQL text.
    """
    df = with_revenue(measures(sales))
    if category is not None:
        df = df.filter(F.col("category") == F.lit(category))
    return (
        df.groupBy("product_name", "category")
        .agg(
            quantity().alias("units_sold"),
            round_money(revenue(), 0).alias("total_revenue"),
            mean_percent(discount(), discount_count(), 1).alias("avg_discount"),
        )
        .orderBy(F.desc("total_revenue"), F.asc_nulls_last("product_name"), F.asc_nulls_last("category"))
        .limit(k)
    )


def discount_scatter(sales: DataFrame) -> DataFrame:
    """Mean discount, revenue and units per product."""
    return (
        with_revenue(measures(sales))
        .groupBy("product_name", "category")
        .agg(
            mean_percent(discount(), discount_count(), 1).alias("avg_discount"),
            round_money(revenue(), 0).alias("total_revenue"),
            quantity().alias("units_sold"),
        )
    )


def bucket_distribution(sales: DataFrame) -> DataFrame:
    """Transactions and revenue per revenue bucket, descending."""
    return (
        with_revenue(measures(sales))
        .groupBy("revenue_bucket")
        .agg(rows().alias("txns"), round_money(revenue(), 0).alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc_nulls_last("revenue_bucket"))
    )


def regional_table(sales: DataFrame) -> DataFrame:
    """Revenue, orders, mean order value and return rate per region."""
    return (
        measures(sales)
        .groupBy("region")
        .agg(
            round_money(revenue(), 0).alias("total_revenue"),
            rows().alias("total_orders"),
            mean_money(revenue(), revenue_count(), 0).alias("avg_order_value"),
            percent(returned(), rows(), 1).alias("return_rate"),
        )
        .orderBy(F.desc("total_revenue"), F.asc_nulls_last("region"))
    )


def heat_long(sales: DataFrame) -> DataFrame:
    """Revenue per (region, category), long form."""
    return (
        with_revenue(measures(sales))
        .groupBy("region", "category")
        .agg(round_money(revenue(), 0).alias("revenue"))
    )


def heat_pivot(sales: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One row per region, one column per listed category, missing cells 0.

    The list (e.g. from D6) is an argument, as it decides the columns. Each cell is a
    conditional sum over the long form, which has one value per cell. Null and unlisted
    categories get no column; their regions still get a row.
    """
    long = heat_long(sales)
    cells = [F.coalesce(F.sum(F.when(F.col("category") == c, F.col("revenue"))), F.lit(0.0)).alias(c) for c in sorted(categories)]
    return long.groupBy("region").agg(*cells).orderBy(F.asc_nulls_last("region"))
