"""Table schemas and fixed value domains.

Money is DECIMAL inside the engine so that sums do not depend on task order;
report outputs are converted to DOUBLE at the very end.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PRICE = T.DecimalType(12, 2)
RATIO = T.DecimalType(6, 4)
# Numbers as read from text: wide enough that the checks see the value itself;
# narrowed to the types above only in the fact table.
WIDE = T.DecimalType(38, 10)

# Raw transaction file, in file column order.
RAW_SALES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", PRICE),
        T.StructField("discount_pct", RATIO),
        T.StructField("final_amount", MONEY),
        T.StructField("payment_method", T.StringType()),
        T.StructField("is_returned", T.BooleanType()),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SALES.fields]

# Cleaned fact table: raw columns (date parsed) plus derived ones.
SALES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", PRICE),
        T.StructField("discount_pct", RATIO),
        T.StructField("final_amount", MONEY),
        T.StructField("payment_method", T.StringType()),
        T.StructField("is_returned", T.BooleanType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("net_revenue", MONEY),
        T.StructField("revenue_bucket", T.StringType()),
    ]
)
SALES_COLUMNS = [f.name for f in SALES.fields]

# Fact table directory layout.
SALES_PARTITION_COLUMNS = ["year", "month"]

# --- Fixed values (must equal the reference's for equal results) -----------
# Value domains of the generated data set.
CATEGORIES = ["Electronics", "Clothing", "Grocery", "Home & Kitchen", "Sports"]
REGIONS = ["North", "South", "East", "West", "Central"]
PAYMENT_METHODS = ["Credit Card", "UPI", "Cash", "Debit Card", "Net Banking"]
PRODUCTS = {
    "Electronics": [("Wireless Earbuds", 1299), ("Smart Watch", 2999), ("Bluetooth Speaker", 899),
                    ("USB Hub", 499), ("Laptop Stand", 799)],
    "Clothing": [("Casual T-Shirt", 399), ("Denim Jeans", 999), ("Formal Shirt", 699),
                 ("Winter Jacket", 1799), ("Sports Shoes", 1499)],
    "Grocery": [("Organic Rice 5kg", 349), ("Olive Oil 1L", 499), ("Almonds 500g", 599),
                ("Green Tea Box", 199), ("Protein Bar Pack", 449)],
    "Home & Kitchen": [("Non-stick Pan", 799), ("Water Purifier", 3499), ("Coffee Maker", 1999),
                       ("Air Fryer", 2799), ("Dinner Set", 1299)],
    "Sports": [("Yoga Mat", 599), ("Resistance Bands", 349), ("Dumbbells Set", 1499),
               ("Cycling Gloves", 299), ("Fitness Tracker", 1999)],
}
# Revenue bucket edges: right-closed bins (0,500], (500,1500], (1500,5000], (5000,inf).
BUCKET_EDGES = [0, 500, 1500, 5000]
BUCKET_LABELS = ["Low", "Medium", "High", "Premium"]
# Label given to amounts outside every bin (0, negative, missing).
BUCKET_NONE = "nan"
# Day names that count as weekend.
WEEKEND_DAYS = ["Saturday", "Sunday"]
# Tokens read as missing in any CSV column.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Calendar range a parsed date must fall in (nanosecond timestamp range, whole days).
MIN_DATE = "1677-09-22"
MAX_DATE = "2262-04-11"
