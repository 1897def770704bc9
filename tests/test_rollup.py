"""Every report that accepts the rollup gives the fact table's exact result."""

from __future__ import annotations

import pytest

from salesengine.operators import summaries as A
from salesengine.operators.rollup import ROLLUP_KEYS, product_rollup, sales_rollup
from salesengine.plans import dashboard as D
from salesengine.plans import questions as N
from salesengine.plans import reports as Q
from salesengine.plans.pipeline import star_sales

SF_SMALL = "/root/testdata/sf0.001"

REPORTS = {
    "A1": A.monthly_category_summary, "A2": A.regional_summary, "P1": A.run_summary,
    "Q1": Q.overview, "Q2": Q.monthly_trend, "Q3": Q.top_categories, "Q4": Q.regional_performance,
    "Q6": Q.payment_share, "Q7": Q.weekend_split, "Q8": Q.revenue_buckets,
    "D1": D.kpis, "D2": D.monthly, "D3": D.category_revenue, "D4": D.payment_counts,
    "D5": D.day_type_split, "D6": D.category_list, "D10": D.bucket_distribution,
    "D11": D.regional_table, "D12": D.heat_long, "D13": lambda s: D.heat_pivot(s, ["Economy", "Promo"]),
    "N1": N.region_return_rate, "N2": lambda s: N.region_return_rate(s, quarter=3),
    "N4": lambda s: N.monthly_in_quarter(s, 1997, 3), "N5": N.weekend_payment, "N6": N.premium_share,
}


PRODUCT_REPORTS = {
    "A3": A.product_summary, "Q5": Q.top_products_by_units, "D7": D.top_products,
    "D8": lambda s: D.top_products(s, category="Economy"), "D9": D.discount_scatter,
    "N3": lambda s: N.top_products_in_category(s, "Economy"),
}


@pytest.mark.parametrize("name", sorted(PRODUCT_REPORTS))
def test_product_rollup_equals_fact_table(spark, name):
    sales = star_sales(spark, SF_SMALL)
    products = product_rollup(sales)
    f = PRODUCT_REPORTS[name]
    a, b = f(sales), f(products)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    sales = star_sales(spark, SF_SMALL)
    return sales, sales_rollup(sales).cache()


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_rollup_equals_fact_table(tables, name):
    sales, rollup = tables
    f = REPORTS[name]
    a, b = f(sales), f(rollup)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_rollup_is_smaller_and_keyed(tables):
    sales, rollup = tables
    assert set(ROLLUP_KEYS) <= set(rollup.columns)
    assert rollup.count() < sales.count()
    assert rollup.agg({"n_rows": "sum"}).collect()[0][0] == sales.count()


def test_empty_input_counts_are_zero(spark, tables):
    sales, rollup = tables
    r = Q.overview(rollup.limit(0)).collect()[0]
    assert r.total_orders == 0 and r.total_net_revenue is None
