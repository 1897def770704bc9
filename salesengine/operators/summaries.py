"""A1-A3 summary tables and the P1 run summary.

All are partial+final hash aggregates over a handful of keys, so the shuffle
carries one row per key per map task. Summary tables drop null group keys
(they are excluded from grouped summaries); the SQL-style reports keep them.
Each takes the fact table or a rollup (A3, which groups by product, the
product rollup; the others the sales rollup).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import as_double, mean, mean_money, percent
from .rollup import (
    discount,
    discount_count,
    flagged,
    ids,
    measures,
    quantity,
    returned,
    revenue,
    revenue_count,
    rows,
    with_revenue,
)


def _keys_present(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond)


def monthly_category_summary(sales: DataFrame) -> DataFrame:
    """A1: revenue, orders and mean order value by year, month, category."""
    keys = ["year", "month", "category"]
    return (
        _keys_present(with_revenue(measures(sales)), keys)
        .groupBy(*keys)
        .agg(
            as_double(revenue()).alias("total_revenue"),
            ids().alias("total_orders"),
            mean(revenue(), revenue_count()).alias("avg_order_value"),
        )
        .orderBy(*keys)
    )


def regional_summary(sales: DataFrame) -> DataFrame:
    """A2: revenue, orders and mean of is_returned by region (over rows with
    revenue, so the rate is 0 by construction: returned rows have none)."""
    return (
        _keys_present(with_revenue(measures(sales)), ["region"])
        .groupBy("region")
        .agg(
            as_double(revenue()).alias("total_revenue"),
            ids().alias("total_orders"),
            mean(returned(), flagged(), scale=0).alias("return_rate"),
        )
        .orderBy("region")
    )


def product_summary(sales: DataFrame) -> DataFrame:
    """A3: revenue, units and mean discount by product, by revenue desc."""
    keys = ["product_name", "category"]
    return (
        _keys_present(with_revenue(measures(sales)), keys)
        .groupBy(*keys)
        .agg(
            as_double(revenue()).alias("total_revenue"),
            quantity().alias("units_sold"),
            mean(discount(), discount_count(), scale=4).alias("avg_discount"),
        )
        .orderBy(F.desc("total_revenue"), *keys)
    )


def run_summary(sales: DataFrame) -> DataFrame:
    """One row — count, date range, revenue, mean order value over rows
    with revenue, return rate (1 decimal) and the sorted category/region lists.

    The lists are bounded by the number of distinct values, not by row count.
    """
    m = measures(sales)
    pos = F.col("has_revenue")
    pos_revenue = F.sum(F.when(pos, F.col("sum_revenue")))
    pos_count = F.coalesce(F.sum(F.when(pos, F.col("n_revenue"))), F.lit(0).cast("long"))
    return m.agg(
        rows().alias("total_records"),
        F.date_format(F.min("min_date"), "yyyy-MM-dd").alias("min_date"),
        F.date_format(F.max("max_date"), "yyyy-MM-dd").alias("max_date"),
        as_double(revenue()).alias("total_net_revenue"),
        mean_money(pos_revenue, pos_count, 2).alias("avg_order_value"),
        percent(returned(), flagged(), 1).alias("return_rate_pct"),
        F.array_join(F.sort_array(F.collect_set("category")), ", ").alias("categories"),
        F.array_join(F.sort_array(F.collect_set("region")), ", ").alias("regions"),
    )
