"""N1-N6 — the example business questions as parameterised reports.

Each answers one of the plain-English example questions with a fixed
definition; ties break on the name, ascending. Parameters are bound values.
Each takes the fact table or a rollup (the product rollup for N3, which
groups by product; the sales rollup for the rest).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import percent, round_money
from ..operators.rollup import ids, measures, returned, revenue, rows, rows_where, with_revenue


def in_quarter(quarter: int) -> Column:
    """quarter = q, plus the equivalent month range: month is a partition
    column of the fact table, so the range prunes directories at planning."""
    return (F.col("quarter") == F.lit(quarter)) & F.col("month").between(3 * quarter - 2, 3 * quarter)


def region_return_rate(sales: DataFrame, quarter: int | None = None, k: int = 1) -> DataFrame:
    """region(s) with the highest return rate, optionally in a quarter."""
    m = measures(sales)
    df = m if quarter is None else m.filter(in_quarter(quarter))
    return (
        df.groupBy("region")
        .agg(returned().alias("returns"), rows().alias("total_orders"))
        .select(
            "region", "returns", "total_orders",
            percent(F.col("returns"), F.col("total_orders"), 2).alias("return_rate_pct"),
        )
        .orderBy((F.col("returns").cast("double") / F.col("total_orders")).desc(), F.asc_nulls_last("region"))
        .limit(k)
    )


def top_products_in_category(sales: DataFrame, category: str, k: int = 3) -> DataFrame:
    """Top-k products by revenue within one category."""
    return (
        with_revenue(measures(sales))
        .filter(F.col("category") == F.lit(category))
        .groupBy("product_name", "category")
        .agg(revenue().alias("_rev"))
        .orderBy(F.desc("_rev"), F.asc_nulls_last("product_name"))
        .limit(k)
        .select("product_name", "category", round_money(F.col("_rev"), 2).alias("total_revenue"))
    )


def monthly_in_quarter(sales: DataFrame, year: int, quarter: int) -> DataFrame:
    """Monthly revenue and orders for one quarter of one year.

    year/month are the fact table's partition columns, so the filter prunes
    to three month directories before any file is opened.
    """
    return (
        with_revenue(measures(sales))
        .filter((F.col("year") == F.lit(year)) & in_quarter(quarter))
        .groupBy("year", "month")
        .agg(round_money(revenue(), 2).alias("monthly_revenue"), ids().alias("total_orders"))
        .orderBy("year", "month")
    )


def weekend_payment(sales: DataFrame, k: int = 1) -> DataFrame:
    """Most used payment method(s) on Saturdays and Sundays."""
    return (
        measures(sales)
        .filter(F.col("day_type") == F.lit("Weekend"))
        .groupBy("payment_method")
        .agg(rows().alias("num_transactions"))
        .orderBy(F.desc("num_transactions"), F.asc_nulls_last("payment_method"))
        .limit(k)
    )


def premium_share(sales: DataFrame, bucket: str = "Premium") -> DataFrame:
    """Share of all orders that fall in one revenue bucket."""
    return measures(sales).agg(
        rows_where(F.col("revenue_bucket") == F.lit(bucket)).alias("premium_orders"),
        rows().alias("total_orders"),
    ).select(
        "premium_orders", "total_orders",
        percent(F.col("premium_orders"), F.col("total_orders"), 2).alias("premium_share_pct"),
    )
