"""G1: domains, determinism across partitioning, rough distribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesengine.operators.generate import generate_sales
from salesengine.schema import CATEGORIES, PAYMENT_METHODS, PRODUCTS, RAW_COLUMNS, REGIONS


def test_same_rows_for_any_partitioning(spark):
    a = generate_sales(spark, 3000, partitions=1)
    b = generate_sales(spark, 3000, partitions=8)
    assert a.columns == RAW_COLUMNS
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_domains(spark):
    df = generate_sales(spark, 20000)
    prod_cat = {name: c for c in CATEGORIES for name, _ in PRODUCTS[c]}
    rows = df.groupBy("category", "product_name").count().collect()
    assert {r.category for r in rows} == set(CATEGORIES)
    assert all(prod_cat[r.product_name] == r.category for r in rows)
    assert len(rows) == 25
    s = df.agg(
        F.min("quantity"), F.max("quantity"), F.min("discount_pct"), F.max("discount_pct"),
        F.min("date"), F.max("date"), F.avg(F.col("is_returned").cast("int")),
        F.count_distinct("transaction_id"),
    ).collect()[0]
    assert (s[0], s[1]) == (1, 5)
    assert float(s[2]) >= 0 and float(s[3]) <= 0.25
    assert s[4] >= "2023-01-01" and s[5] <= "2023-12-31"
    assert 0.04 < s[6] < 0.06
    assert s[7] == 20000
    assert {r[0] for r in df.select("region").distinct().collect()} == set(REGIONS)
    assert {r[0] for r in df.select("payment_method").distinct().collect()} == set(PAYMENT_METHODS)


def test_prices_within_spread(spark):
    df = generate_sales(spark, 5000)
    base = {name: b for c in CATEGORIES for name, b in PRODUCTS[c]}
    for r in df.select("product_name", "unit_price").collect():
        assert 0.9 * base[r.product_name] - 0.01 <= float(r.unit_price) <= 1.1 * base[r.product_name] + 0.01
