"""G1 — synthetic raw sale rows as a distributed Spark job.

Every random draw is a pure function of (row id, salt), so the rows do not
depend on partitioning or on which executor computes them, and a recomputed
partition after an executor loss yields the same rows. ``rand(seed)`` is not
used (its stream depends on the partition layout). Products are looked up by
index in literal arrays: a projection, no join and nothing broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CATEGORIES, MONEY, PAYMENT_METHODS, PRICE, PRODUCTS, RATIO, REGIONS

# --- Fixed values of the integer hash (a Lehmer-style mixer) --------------------
_P = 2**31 - 1
_MUL_ID = 48271
_MUL_SALT = 69621
_ADD = 12345
_ROUND_ADDS = (1013904223, 1664525)
_ROUND_MUL = 16807

# Generator parameters.
START_DATE = "2023-01-01"
DAYS = 365
FIRST_ID = 100000
RETURN_RATE = 0.05
MAX_DISCOUNT = 0.25
MAX_QUANTITY = 5
PRICE_SPREAD = 0.10   # unit price = base * uniform(1 - spread, 1 + spread)


def uniform(row_id: Column, salt: int) -> Column:
    """A number in [0, 1) from (row id, salt); all steps fit in BIGINT."""
    e = (row_id * _MUL_ID + F.lit(salt * _MUL_SALT + _ADD)) % _P
    for k in _ROUND_ADDS:
        e = ((e * e + F.lit(k)) % _P) * _ROUND_MUL % _P
    return e.cast("double") / float(_P)


def _pick(values: list, u: Column) -> Column:
    """values[floor(u * len)] via a literal array (1-based element_at)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (u * len(values)).cast("int") + 1)


def generate_sales(spark: SparkSession, n: int, salt: int = 0, partitions: int | None = None) -> DataFrame:
    """n raw sale rows in RAW_SALES layout (date as ``yyyy-MM-dd`` text).

    Uniform category, uniform product within it, unit price = base price
    +/- PRICE_SPREAD (2 decimals), quantity 1..MAX_QUANTITY, discount
    0..MAX_DISCOUNT (2 decimals), final amount = price * qty * (1 - discount)
    (2 decimals), a uniform day of the year, region, payment method, and
    RETURN_RATE returned; ids ``TXN<FIRST_ID + i>``.
    """
    ids = spark.range(0, n, numPartitions=partitions)
    i = F.col("id")
    u = [uniform(i, salt * 16 + s) for s in range(10)]

    names = [name for c in CATEGORIES for name, _ in PRODUCTS[c]]
    bases = [base for c in CATEGORIES for _, base in PRODUCTS[c]]
    per_cat = len(PRODUCTS[CATEGORIES[0]])
    cat_idx = (u[0] * len(CATEGORIES)).cast("int")
    prod_idx = cat_idx * per_cat + (u[1] * per_cat).cast("int") + 1

    base = F.element_at(F.array(*[F.lit(b) for b in bases]), prod_idx).cast("decimal(10,2)")
    factor = (F.lit(1 - PRICE_SPREAD) + u[2] * (2 * PRICE_SPREAD)).cast("decimal(12,10)")
    price = F.round(base * factor, 2).cast(PRICE)
    qty = (u[3] * MAX_QUANTITY).cast("int") + 1
    disc = F.round((u[4] * MAX_DISCOUNT).cast("decimal(12,10)"), 2).cast(RATIO)
    final = F.round(price * qty * (F.lit(1) - disc), 2).cast(MONEY)
    day = F.date_add(F.lit(START_DATE).cast("date"), (u[5] * DAYS).cast("int"))

    return ids.select(
        F.concat(F.lit("TXN"), (i + FIRST_ID).cast("string")).alias("transaction_id"),
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        F.element_at(F.array(*[F.lit(x) for x in names]), prod_idx).alias("product_name"),
        _pick(CATEGORIES, u[0]).alias("category"),
        _pick(REGIONS, u[6]).alias("region"),
        qty.alias("quantity"),
        price.alias("unit_price"),
        disc.alias("discount_pct"),
        final.alias("final_amount"),
        _pick(PAYMENT_METHODS, u[7]).alias("payment_method"),
        (u[8] < RETURN_RATE).alias("is_returned"),
    )
