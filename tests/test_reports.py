"""Summary tables and reports: null keys, invariants, pivot, rounding."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesengine.functions.rounding import mean_percent, percent, round_money
from salesengine.operators import summaries as A
from salesengine.plans import dashboard as D
from salesengine.plans import questions as N
from salesengine.plans import reports as Q
from salesengine.schema import SALES


def sale(tid, region, category, nr, returned=False, product="P", qty=1, disc="0.1000",
         date=dt.date(2023, 1, 7), bucket="Low", pay="UPI"):
    return (tid, date, product, category, region, qty, Decimal("1.00"), Decimal(disc), Decimal(nr), pay,
            returned, date.year, date.month, (date.month - 1) // 3 + 1, date.strftime("%A"),
            Decimal("0") if returned else Decimal(nr), bucket)


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        sale("1", "North", "Sports", "10.00"),
        sale("2", "North", "Grocery", "20.00", product="Q"),
        sale("3", "South", "Sports", "30.00", returned=True),
        sale("4", None, "Sports", "5.00"),
        sale("5", "South", None, "7.00"),
        sale("6", "East", "Sports", "0.00", bucket="nan"),
    ]
    return spark.createDataFrame(rows, SALES)


def test_summary_tables_drop_null_keys(sales):
    assert None not in {r.region for r in A.regional_summary(sales).collect()}
    assert None not in {r.category for r in A.monthly_category_summary(sales).collect()}
    assert None not in {r.category for r in A.product_summary(sales).collect()}


def test_regional_summary_return_rate_is_zero(sales):
    assert all(r.return_rate == 0.0 for r in A.regional_summary(sales).collect())


def test_reports_keep_null_groups(sales):
    assert None in {r.region for r in Q.regional_performance(sales).collect()}


def test_pivot_fills_missing_cells(sales):
    rows = {r.region: r for r in D.heat_pivot(sales, ["Grocery", "Sports"]).collect()}
    assert rows["North"].Grocery == 20.0 and rows["North"].Sports == 10.0
    assert rows["South"].Grocery == 0.0  # no Grocery revenue in South
    discovered = D.heat_pivot(sales, ["Sports", "Grocery"])
    assert discovered.columns == ["region", "Grocery", "Sports"]


def test_heat_long_sums_to_category_totals(sales):
    long = D.heat_long(sales).groupBy("category").agg(F.sum("revenue").alias("r"))
    cat = {r.category: r.revenue for r in D.category_revenue(sales).collect()}
    assert {r.category: r.r for r in long.collect()} == cat


def test_payment_share_sums_to_100(sales):
    total = sum(r.pct_share for r in Q.payment_share(sales).collect())
    assert abs(total - 100.0) < 0.05


def test_overview_values(sales):
    r = Q.overview(sales).collect()[0]
    assert r.total_orders == 6
    assert r.total_net_revenue == 42.0  # 10+20+0+5+7+0
    assert r.avg_order_value == 7.0
    assert r.return_rate_pct == 16.67  # 1/6


def test_top_k_ties_break_on_name(spark):
    rows = [sale(str(i), "North", c, "10.00") for i, c in enumerate(["B", "A", "C", "D", "E", "F"])]
    df = spark.createDataFrame(rows, SALES)
    assert [r.category for r in Q.top_categories(df).collect()] == ["A", "B", "C", "D", "E"]


def test_question_reports(sales):
    assert N.region_return_rate(sales).collect()[0].region == "South"
    assert N.weekend_payment(sales).collect()[0].payment_method == "UPI"  # 2023-01-07 is a Saturday
    share = N.premium_share(sales).collect()[0]
    assert (share.premium_orders, share.total_orders, share.premium_share_pct) == (0, 6, 0.0)


@pytest.mark.parametrize("k,n,digits,want", [(1, 8, 2, 12.5), (1, 3, 2, 33.33), (2, 3, 2, 66.67),
                                             (1, 200, 1, 0.5), (1, 400, 1, 0.3), (0, 5, 2, 0.0)])
def test_percent_half_away_from_zero(spark, k, n, digits, want):
    got = spark.range(1).select(percent(F.lit(k), F.lit(n), digits)).collect()[0][0]
    assert got == want


def test_money_rounding(spark):
    df = spark.createDataFrame([(Decimal("2.50"),), (Decimal("3.49"),), (Decimal("-2.50"),)], "x decimal(18,2)")
    assert [r[0] for r in df.select(round_money("x", 0)).collect()] == [3.0, 3.0, -3.0]
    d = spark.createDataFrame([(Decimal("0.1235"),)], "x decimal(6,4)")
    assert d.select(mean_percent("x", F.lit(1), 2)).collect()[0][0] == 12.35


def test_pivot_odd_category_names(spark):
    rows = [sale("1", "North", "a.b", "10.00"), sale("2", "North", "x`y & z", "20.00")]
    out = D.heat_pivot(spark.createDataFrame(rows, SALES), ["x`y & z", "a.b"]).collect()[0]
    assert out.asDict() == {"region": "North", "a.b": 10.0, "x`y & z": 20.0}


def test_rounding_zero_denominator_and_large_values(spark):
    from salesengine.functions.rounding import mean_money, round_ratio

    r = spark.range(1).select(
        percent(F.lit(3), F.lit(0), 2).alias("p"),
        mean_money(F.lit(Decimal("10.00")), F.lit(0), 2).alias("m"),
        round_ratio(F.lit(Decimal(10**20 + 5)), F.lit(10), 0).alias("big"),
        round_ratio(F.lit(-15), F.lit(10), 0).alias("neg"),
        percent(F.lit(None).cast("long"), F.lit(5), 2).alias("nul"),
    ).collect()[0]
    assert r.p is None and r.m is None and r.nul is None
    assert r.big == float(10**19 + 1)  # (10^20 + 5) / 10 = 10^19 + 0.5 -> away from zero
    assert r.neg == -2.0


def test_round_ratio_matches_exact_decimal_rounding(spark):
    import random
    from decimal import ROUND_HALF_UP, Context, Decimal as D

    from salesengine.functions.rounding import round_ratio

    rnd = random.Random(7)
    cases = []
    for _ in range(500):
        num = rnd.choice([rnd.randint(-10**6, 10**6), rnd.randint(-10**30, 10**30), rnd.randint(0, 10**18) * 5])
        den = rnd.choice([rnd.randint(1, 1000), rnd.randint(1, 10**12), 2, 8, 10])
        digits, scale = rnd.choice([(0, 0), (2, 0), (1, 2), (2, 2), (0, 2), (1, 4), (2, 4)])
        cases.append((D(num), D(den), digits, scale))
    df = spark.createDataFrame([(a, b) for a, b, _, _ in cases], "num decimal(38,0), den decimal(38,0)")
    exprs = [round_ratio(F.col("num"), F.col("den"), d, s).alias(f"r_{d}_{s}") for d, s in sorted({(d, s) for *_, d, s in cases})]
    got = df.select("num", "den", *exprs).collect()
    ctx = Context(prec=100)
    for (num, den, d, s), row in zip(cases, got):
        # The contract: the exact value rounded half away from zero to d
        # decimals, as an integer count of 10^-d units, converted to DOUBLE
        # once and divided by 10^d once (both correctly rounded).
        units = ctx.divide(num * D(10) ** d, den * D(10) ** s).to_integral_value(rounding=ROUND_HALF_UP)
        assert row[f"r_{d}_{s}"] == float(int(units)) / float(10**d), (num, den, d, s)
