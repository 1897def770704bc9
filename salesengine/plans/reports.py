"""Q1-Q8 — the reporting query pack.

Money is rounded to 2 decimals and percentages to 2 decimals, half away from
zero on exact values. Top-k reports break ties on the name so that the rows
kept by LIMIT are deterministic; they plan as TakeOrderedAndProject.

Every report takes the fact table or a rollup (``operators.rollup``: the
sales rollup, or for Q5, which groups by product, the product rollup) and
gives the same result from either.
"""

from __future__ import annotations

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


def overview(sales: DataFrame) -> DataFrame:
    """Q1: orders, revenue, mean order value and return rate over all rows."""
    return measures(sales).agg(
        ids().alias("total_orders"),
        round_money(revenue(), 2).alias("total_net_revenue"),
        mean_money(revenue(), revenue_count(), 2).alias("avg_order_value"),
        percent(returned(), rows(), 2).alias("return_rate_pct"),
    )


def monthly_trend(sales: DataFrame) -> DataFrame:
    """Q2: revenue and orders per month, rows with revenue."""
    return (
        with_revenue(measures(sales))
        .groupBy("year", "month")
        .agg(round_money(revenue(), 2).alias("monthly_revenue"), ids().alias("total_orders"))
        .orderBy("year", "month")
    )


def top_categories(sales: DataFrame, k: int = 5) -> DataFrame:
    """Q3: top-k categories by revenue with mean discount in percent."""
    return (
        with_revenue(measures(sales))
        .groupBy("category")
        .agg(
            round_money(revenue(), 2).alias("total_revenue"),
            ids().alias("total_orders"),
            mean_percent(discount(), discount_count(), 2).alias("avg_discount_pct"),
        )
        .orderBy(F.desc("total_revenue"), F.asc_nulls_last("category"))
        .limit(k)
    )


def regional_performance(sales: DataFrame) -> DataFrame:
    """Q4: revenue, orders and return rate by region over all rows."""
    return (
        measures(sales)
        .groupBy("region")
        .agg(
            round_money(revenue(), 2).alias("total_revenue"),
            ids().alias("total_orders"),
            percent(returned(), rows(), 2).alias("return_rate_pct"),
        )
        .orderBy(F.desc("total_revenue"), F.asc_nulls_last("region"))
    )


def top_products_by_units(sales: DataFrame, k: int = 10) -> DataFrame:
    """Q5: top-k products by units sold, rows with revenue."""
    return (
        with_revenue(measures(sales))
        .groupBy("product_name", "category")
        .agg(quantity().alias("units_sold"), round_money(revenue(), 2).alias("total_revenue"))
        .orderBy(F.desc("units_sold"), F.asc_nulls_last("product_name"), F.asc_nulls_last("category"))
        .limit(k)
    )


def payment_share(sales: DataFrame) -> DataFrame:
    """Q6: transactions per payment method and their share of all rows.

    The total is an uncorrelated scalar subquery (a count Spark runs once and
    plugs in as a literal), not a cross join.
    """
    m = measures(sales)
    total = m.select(rows()).scalar()
    return (
        m.groupBy("payment_method")
        .agg(rows().alias("num_transactions"))
        # Bind the subquery to a column once; the rounding expression reads
        # its denominator several times and would otherwise plan one
        # subquery (one extra job) per reference.
        .withColumn("_total", total)
        .select("payment_method", "num_transactions",
                percent(F.col("num_transactions"), F.col("_total"), 2).alias("pct_share"))
        .orderBy(F.desc("num_transactions"), F.asc_nulls_last("payment_method"))
    )


def weekend_split(sales: DataFrame) -> DataFrame:
    """Q7: weekend vs weekday orders, revenue, mean order value."""
    return (
        with_revenue(measures(sales))
        .groupBy("day_type")
        .agg(
            ids().alias("total_orders"),
            round_money(revenue(), 2).alias("total_revenue"),
            mean_money(revenue(), revenue_count(), 2).alias("avg_order_value"),
        )
    )


def revenue_buckets(sales: DataFrame) -> DataFrame:
    """Q8: transactions, revenue, mean order value per revenue bucket."""
    return (
        with_revenue(measures(sales))
        .groupBy("revenue_bucket")
        .agg(
            rows().alias("num_transactions"),
            round_money(revenue(), 2).alias("total_revenue"),
            mean_money(revenue(), revenue_count(), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc("avg_order_value"), F.asc_nulls_last("revenue_bucket"))
    )
