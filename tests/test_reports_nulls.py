"""Reports on random sales with nulls in keys and measures: Spark (on the fact
table and on the rollups) against the DuckDB statements."""

from __future__ import annotations

import datetime as dt
import os
import random
import sys
from decimal import Decimal

import duckdb
import pytest

from oracle.duckdb_sql import report_sql
from salesengine.operators import summaries as A
from salesengine.operators.rollup import product_rollup, sales_rollup
from salesengine.plans import dashboard as D
from salesengine.plans import questions as N
from salesengine.plans import reports as Q
from salesengine.schema import SALES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import rows_of  # noqa: E402

SALES_REPORTS = {
    "monthly_category_summary": A.monthly_category_summary, "regional_summary": A.regional_summary,
    "run_summary": A.run_summary, "rpt_overview": Q.overview, "rpt_monthly": Q.monthly_trend,
    "rpt_top_categories": Q.top_categories, "rpt_regional": Q.regional_performance,
    "rpt_payment_share": Q.payment_share, "rpt_day_type": Q.weekend_split, "rpt_buckets": Q.revenue_buckets,
    "dash_kpis": D.kpis, "dash_monthly": D.monthly, "dash_category": D.category_revenue,
    "dash_payment": D.payment_counts, "dash_day_type": D.day_type_split, "dash_category_list": D.category_list,
    "dash_buckets": D.bucket_distribution, "dash_regional": D.regional_table, "dash_heat_long": D.heat_long,
    "q_region_return": N.region_return_rate,
    "q_region_return_quarter": lambda s: N.region_return_rate(s, quarter=3),
    "q_monthly_in_quarter": lambda s: N.monthly_in_quarter(s, 1997, 3),
    "q_weekend_payment": N.weekend_payment, "q_premium_share": N.premium_share,
}
PRODUCT_REPORTS = {
    "product_summary": A.product_summary, "rpt_top_products_units": Q.top_products_by_units,
    "dash_top_products": D.top_products, "dash_top_products_cat": lambda s: D.top_products(s, category="Economy"),
    "dash_discount_scatter": D.discount_scatter,
    "q_top_products_in_category": lambda s: N.top_products_in_category(s, "Economy"),
}


def _maybe(rnd, value, p=0.08):
    return None if rnd.random() < p else value


def _random_sales(n: int, seed: int):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        d = dt.date(1996, 1, 1) + dt.timedelta(days=rnd.randint(0, 3 * 365))
        returned = _maybe(rnd, rnd.random() < 0.3)
        fa = _maybe(rnd, Decimal(rnd.randint(0, 600000)) / 100)
        nr = Decimal(0) if (returned is None or returned) else fa
        rows.append((
            _maybe(rnd, f"T{i}"), d, _maybe(rnd, rnd.choice(["P1", "P2", "P3", "P4", "P5", "P6"])),
            _maybe(rnd, rnd.choice(["Economy", "Large", "Promo"])), _maybe(rnd, rnd.choice(["North", "South", "East"])),
            _maybe(rnd, rnd.randint(1, 5)), Decimal("1.00"), _maybe(rnd, Decimal(rnd.randint(0, 10000)) / 10000),
            fa, _maybe(rnd, rnd.choice(["UPI", "Cash"])), returned, d.year, d.month, (d.month - 1) // 3 + 1,
            d.strftime("%A"), None if nr is None else Decimal(nr).quantize(Decimal("0.01")),
            rnd.choice(["Low", "High", "nan"]),
        ))
    return rows


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nulls") / "sales")
    spark.createDataFrame(_random_sales(4000, 17), SALES).write.parquet(path)
    sales = spark.read.schema(SALES).parquet(path)
    con = duckdb.connect()
    sql = report_sql(f"WITH sales AS (SELECT * FROM read_parquet('{path}/*.parquet'))\n")
    return sales, sales_rollup(sales).cache(), product_rollup(sales).cache(), con, sql


@pytest.mark.parametrize("key", sorted(SALES_REPORTS) + sorted(PRODUCT_REPORTS))
def test_report_with_nulls_matches_duckdb(data, key):
    sales, rollup, products, con, sql = data
    res = con.execute(sql[key])
    want = rows_of([c[0] for c in res.description], res.fetchall())
    f = SALES_REPORTS.get(key) or PRODUCT_REPORTS[key]
    for source in (sales, rollup if key in SALES_REPORTS else products):
        df = f(source)
        got = rows_of(df.columns, [tuple(r) for r in df.collect()])
        assert got == want, (key, got[1][:3], want[1][:3])
