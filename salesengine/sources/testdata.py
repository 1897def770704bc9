"""Raw transactions derived from the star-schema test tables.

The supplied tables are a lineitem/orders/part/customer/nation/region star.
This view maps each line item to one raw sale and deliberately dirties it, so
every cleaning step has real work: transaction ids repeat (line numbers are
per order, so about a quarter of the rows share a key), some dates are
unparseable, some prices are zero, discounts leave [0, 1], categories carry
stray spaces and upper case, regions are lower case. Every line item of the
whole tables becomes a row: the two part-key moduli below only choose which
rows get a dirty value, they never filter rows out.

Joins are plain equi-joins on the star keys; the fact side is never broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MONEY, PRICE, RATIO

# Columns that order the copies of one transaction id ("first" row wins).
ORDER_COLUMNS = ["_ord_ship", "_ord_part", "_ord_supp"]

# --- Fixed values of the test mapping ----------------------------------------
BAD_DATE_MODULUS = 97      # l_partkey % 97 == 0 -> unparseable date text
BAD_DATE_TEXT = "not-a-date"
ZERO_PRICE_MODULUS = 101   # l_partkey % 101 == 0 -> unit price 0
PRICE_FACTOR = "0.1"       # scales line prices into the sale amount range
DISCOUNT_FACTOR = 15       # discount * 15 - 0.1 leaves [0, 1] on both sides
DISCOUNT_OFFSET = "0.1"

# Parameters used by the registered parameterised reports on this data.
PARAM_CATEGORY = "Economy"
PARAM_YEAR = 1997
PARAM_QUARTER = 3


# Declared layouts of the star tables: reading with a schema skips the
# footer-reading job Spark otherwise runs per table to infer one.
STAR_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def load_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    base = sf_dir.rstrip("/")
    return {n: spark.read.schema(STAR_SCHEMAS[n]).parquet(f"{base}/{n}.parquet") for n in names}


def raw_sales_from_star(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """RAW_SALES columns plus ORDER_COLUMNS, one row per line item.

    With ``together`` all lines of an order, so all copies of a transaction id (below it is made of the order's key), lie in one
    partition. The order-key join then comes last, on rows dealt out for it: a user's own repartition, which the join
    keeps and never splits for skew. Other readers would only move the parts' texts through one more shuffle.
    """
    t = load_tables(spark, sf_dir, ["lineitem", "orders", "part", "customer", "nation", "region"])
    li, o, p, c, n, r = (t[k] for k in ["lineitem", "orders", "part", "customer", "nation", "region"])

    # Orders get their region first (orders x customer x nation x region: a
    # quarter of the fact rows, and nation/region are broadcast by size), then
    # the line items join them once on the order key and the parts on the
    # part key. The order-key join carries a merge hint: the fact side must
    # never be the broadcast side (join outputs are estimated as products, so
    # without the hint a small fact table looks smaller than the joined
    # dimension), and at cluster scale both sides are far past any broadcast
    # bound anyway. The sort-merge join spills instead of failing and its
    # shuffle spreads a single-split input over all cores. The part join is
    # left to size-based selection (broadcast when part is small).
    geo = (
        c.select("c_custkey", "c_nationkey")
        .join(n.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "r_name")
    )
    orders = (
        o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        .join(geo, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "o_orderpriority", "r_name")
    )
    lines = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate",
    )
    parts, of_part = p.select("p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    orders, of_order = orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    if together:
        base = lines.join(parts, of_part).repartition("l_orderkey").join(orders, of_order)
    else:
        base = lines.join(orders, of_order).join(parts, of_part)

    price = F.col("l_extendedprice").cast("decimal(15,2)") * F.lit(PRICE_FACTOR).cast("decimal(2,1)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    return base.select(
        F.concat(F.lit("TXN"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.when(F.col("l_partkey") % BAD_DATE_MODULUS == 0, F.lit(BAD_DATE_TEXT))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit(" "), F.upper("p_type"), F.lit(" ")).alias("category"),
        F.lower("r_name").alias("region"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_partkey") % ZERO_PRICE_MODULUS == 0, F.lit(0).cast(PRICE))
        .otherwise(F.round(price, 2)).cast(PRICE).alias("unit_price"),
        (disc * F.lit(DISCOUNT_FACTOR) - F.lit(DISCOUNT_OFFSET).cast("decimal(2,1)")).cast(RATIO).alias("discount_pct"),
        F.round(price * (F.lit(1) - disc), 2).cast(MONEY).alias("final_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        (F.col("l_returnflag") == "R").alias("is_returned"),
        F.col("l_shipdate").alias("_ord_ship"),
        F.col("l_partkey").alias("_ord_part"),
        F.col("l_suppkey").alias("_ord_supp"),
    )
