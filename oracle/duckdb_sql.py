"""DuckDB SQL equivalents of every registered query, for the correctness gate.

Each statement rebuilds the raw view from the star-schema test tables, runs
the cleaning chain in SQL and then the report, so it checks the Spark job end
to end. Rounding uses the same exact integer formulas as the engine.
"""

from __future__ import annotations

# --- expression helpers --------------------------------------------------------


def _ratio(num: str, den: str, digits: int, num_scale: int = 0) -> str:
    shift = digits - num_scale
    top = f"(CAST({num} AS HUGEINT) * {10 ** max(shift, 0)})"
    bot = f"(CAST({den} AS HUGEINT) * {10 ** max(-shift, 0)})"
    return (
        f"(CASE WHEN {bot} <> 0 THEN CAST(sign({top}) * ((2 * abs({top}) + {bot}) // (2 * {bot})) AS DOUBLE)"
        f" / CAST({10 ** digits} AS DOUBLE) END)"
    )


def _units(total: str, scale: int) -> str:
    return f"CAST(({total}) * {10 ** scale} AS HUGEINT)"


def rmoney(total: str, digits: int) -> str:
    return _ratio(_units(total, 2), "1", digits, 2)


def mmoney(total: str, n: str, digits: int) -> str:
    return _ratio(_units(total, 2), n, digits, 2)


def pct(k: str, n: str, digits: int) -> str:
    return _ratio(f"(CAST({k} AS HUGEINT) * 100)", n, digits)


def mpct(total: str, n: str, digits: int, scale: int = 4) -> str:
    return _ratio(_units(total, scale), n, digits, scale - 2)


def dbl(total: str, scale: int = 2) -> str:
    return f"(CAST({_units(total, scale)} AS DOUBLE) / CAST({10 ** scale} AS DOUBLE))"


def mean(total: str, n: str, scale: int = 2) -> str:
    return (
        f"(CASE WHEN ({n}) <> 0 THEN CAST({_units(total, scale)} AS DOUBLE)"
        f" / CAST(CAST({n} AS HUGEINT) * {10 ** scale} AS DOUBLE) END)"
    )


def title(c: str) -> str:
    strip = rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
    return (
        f"(CASE WHEN {c} IS NOT NULL THEN array_to_string(list_transform("
        rf"regexp_extract_all({strip}, '(\p{{L}}+|\P{{L}}+)'), "
        "lambda x: upper(x[1]) || lower(x[2:])), '') END)"
    )


def parse_date(c: str) -> str:
    d = f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"
    return (
        f"(CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')"
        f" AND {d} BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' THEN {d} END)"
    )


def bucket(c: str) -> str:
    return (
        f"(CASE WHEN {c} IS NULL OR {c} <= 0 THEN 'nan' WHEN {c} <= 500 THEN 'Low'"
        f" WHEN {c} <= 1500 THEN 'Medium' WHEN {c} <= 5000 THEN 'High' ELSE 'Premium' END)"
    )


BAD_PRICE = "coalesce(unit_price <= 0 OR final_amount < 0, FALSE)"
NET_REVENUE = "CAST(CASE WHEN coalesce(is_returned, TRUE) THEN 0 ELSE final_amount END AS DECIMAL(18,2))"
CLIP = (
    "CAST(CASE WHEN discount_pct < 0 THEN 0 WHEN discount_pct > 1 THEN 1 ELSE discount_pct END"
    " AS DECIMAL(6,4))"
)
CALENDAR = (
    "CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
    "CAST(quarter(date) AS INTEGER) AS quarter, dayname(date) AS weekday"
)

# --- the raw view and the cleaning chain ---------------------------------------

RAW = """raw AS (
  SELECT
    'TXN' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
    CASE WHEN l.l_partkey % 97 = 0 THEN 'not-a-date' ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS date,
    p.p_name AS product_name,
    ' ' || upper(p.p_type) || ' ' AS category,
    lower(r.r_name) AS region,
    CAST(l.l_quantity AS INTEGER) AS quantity,
    CAST(CASE WHEN l.l_partkey % 101 = 0 THEN 0
         ELSE round(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(0.1 AS DECIMAL(2,1)), 2) END
         AS DECIMAL(12,2)) AS unit_price,
    CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 15 - CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(6,4)) AS discount_pct,
    CAST(round(CAST(l.l_extendedprice AS DECIMAL(15,2)) * CAST(0.1 AS DECIMAL(2,1))
         * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS final_amount,
    o.o_orderpriority AS payment_method,
    l.l_returnflag = 'R' AS is_returned,
    l.l_shipdate AS _ord_ship, l.l_partkey AS _ord_part, l.l_suppkey AS _ord_supp
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

RAW_COLS = (
    "transaction_id, date, product_name, category, region, quantity, unit_price, discount_pct, "
    "final_amount, payment_method, is_returned"
)

DEDUP = """d1 AS (
  SELECT """ + RAW_COLS + """ FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _ord_ship, _ord_part, _ord_supp) AS _rn
    FROM raw) t
  WHERE _rn = 1
)"""

SALES = f"""d2 AS (
  SELECT * REPLACE ({parse_date('date')} AS date) FROM d1
), sales AS (
  SELECT transaction_id, date, product_name, {title('category')} AS category, {title('region')} AS region,
         quantity, unit_price, {CLIP} AS discount_pct, final_amount, payment_method, is_returned,
         {CALENDAR}, {NET_REVENUE} AS net_revenue, {bucket('final_amount')} AS revenue_bucket
  FROM d2
  WHERE date IS NOT NULL AND NOT {BAD_PRICE}
)"""

WITH_SALES = f"WITH {RAW}, {DEDUP}, {SALES}\n"


def _portable(cols: list[str], parsed: bool = False) -> str:
    """Output projection: DATE -> ISO text, DECIMAL -> DOUBLE."""
    conv = {
        "date": "strftime(date, '%Y-%m-%d') AS date" if parsed else "date",
        "unit_price": f"{dbl('unit_price')} AS unit_price",
        "discount_pct": f"{dbl('discount_pct', 4)} AS discount_pct",
        "final_amount": f"{dbl('final_amount')} AS final_amount",
        "net_revenue": f"{dbl('net_revenue')} AS net_revenue",
    }
    return ", ".join(conv.get(c, c) for c in cols)


RAW_LIST = [c.strip() for c in RAW_COLS.split(",")]
SALES_LIST = RAW_LIST + ["year", "month", "quarter", "weekday", "net_revenue", "revenue_bucket"]


def _clean_queries() -> dict[str, str]:
    w = f"WITH {RAW}"
    raw_out = _portable(RAW_LIST)
    parsed = f"SELECT * REPLACE ({parse_date('date')} AS date) FROM raw"
    cal_cols = RAW_LIST + ["year", "month", "quarter", "weekday"]
    return {
        "clean_dedupe": f"WITH {RAW}, {DEDUP} SELECT {raw_out} FROM d1",
        "clean_dates": f"{w}, p AS ({parsed}) SELECT {_portable(RAW_LIST, True)} FROM p WHERE date IS NOT NULL",
        "clean_calendar": (
            f"{w}, p AS ({parsed}), c AS (SELECT *, {CALENDAR} FROM p WHERE date IS NOT NULL) "
            f"SELECT {_portable(cal_cols, True)} FROM c"
        ),
        "clean_prices": f"{w} SELECT {raw_out} FROM raw WHERE NOT {BAD_PRICE}",
        "clean_discount": f"{w}, c AS (SELECT * REPLACE ({CLIP} AS discount_pct) FROM raw) SELECT {raw_out} FROM c",
        "clean_net_revenue": (
            f"{w}, c AS (SELECT *, {NET_REVENUE} AS net_revenue FROM raw) "
            f"SELECT {_portable(RAW_LIST + ['net_revenue'])} FROM c"
        ),
        "clean_text": (
            f"{w}, c AS (SELECT * REPLACE ({title('category')} AS category, {title('region')} AS region) FROM raw) "
            f"SELECT {raw_out} FROM c"
        ),
        "clean_bucket": (
            f"{w}, c AS (SELECT *, {bucket('final_amount')} AS revenue_bucket FROM raw) "
            f"SELECT {_portable(RAW_LIST + ['revenue_bucket'])} FROM c"
        ),
        "clean_sales": f"{WITH_SALES} SELECT {_portable(SALES_LIST, True)} FROM sales",
        "quality_counts": f"""WITH {RAW}, f AS (
  SELECT count(*) OVER (PARTITION BY transaction_id) AS copies,
         row_number() OVER (PARTITION BY transaction_id ORDER BY _ord_ship, _ord_part, _ord_supp) AS rn,
         {parse_date('date')} IS NOT NULL AS date_ok, {BAD_PRICE} AS price_bad
  FROM raw)
SELECT CAST(sum(copies) AS BIGINT) AS raw_rows,
       CAST(sum(copies) - count(*) AS BIGINT) AS duplicates,
       CAST(count(*) FILTER (WHERE NOT date_ok) AS BIGINT) AS bad_dates,
       CAST(count(*) FILTER (WHERE date_ok AND price_bad) AS BIGINT) AS bad_prices,
       CAST(count(*) FILTER (WHERE date_ok AND NOT price_bad) AS BIGINT) AS clean_rows
FROM f WHERE rn = 1""",
    }


POS = "FROM sales WHERE net_revenue > 0"
DAY_TYPE = "CASE WHEN weekday IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END"
RET = "count(*) FILTER (WHERE is_returned)"


def _report_queries(s: str = WITH_SALES) -> dict[str, str]:
    """Report SQL over a ``sales`` relation; ``s`` is the WITH clause that
    defines it (by default: the raw view plus the cleaning chain)."""
    nr = "sum(net_revenue)"
    return {
        # A1-A3, P1
        "monthly_category_summary": f"""{s}
SELECT year, month, category, {dbl(nr)} AS total_revenue, count(transaction_id) AS total_orders,
       {mean(nr, 'count(net_revenue)')} AS avg_order_value
{POS} AND year IS NOT NULL AND month IS NOT NULL AND category IS NOT NULL
GROUP BY year, month, category ORDER BY year, month, category""",
        "regional_summary": f"""{s}
SELECT region, {dbl(nr)} AS total_revenue, count(transaction_id) AS total_orders,
       {mean(RET, 'count(is_returned)', 0)} AS return_rate
{POS} AND region IS NOT NULL GROUP BY region ORDER BY region""",
        "product_summary": f"""{s}
SELECT product_name, category, {dbl(nr)} AS total_revenue, CAST(sum(quantity) AS BIGINT) AS units_sold,
       {mean('sum(discount_pct)', 'count(discount_pct)', 4)} AS avg_discount
{POS} AND product_name IS NOT NULL AND category IS NOT NULL
GROUP BY product_name, category ORDER BY total_revenue DESC, product_name, category""",
        "run_summary": f"""{s}
SELECT count(*) AS total_records, strftime(min(date), '%Y-%m-%d') AS min_date,
       strftime(max(date), '%Y-%m-%d') AS max_date, {dbl(nr)} AS total_net_revenue,
       {mmoney('sum(net_revenue) FILTER (WHERE net_revenue > 0)', 'count(net_revenue) FILTER (WHERE net_revenue > 0)', 2)} AS avg_order_value,
       {pct(RET, 'count(is_returned)', 1)} AS return_rate_pct,
       array_to_string(list_sort(list_distinct(list(category))), ', ') AS categories,
       array_to_string(list_sort(list_distinct(list(region))), ', ') AS regions
FROM sales""",
        # Q1-Q8
        "rpt_overview": f"""{s}
SELECT count(transaction_id) AS total_orders, {rmoney(nr, 2)} AS total_net_revenue,
       {mmoney(nr, 'count(net_revenue)', 2)} AS avg_order_value, {pct(RET, 'count(*)', 2)} AS return_rate_pct
FROM sales""",
        "rpt_monthly": f"""{s}
SELECT year, month, {rmoney(nr, 2)} AS monthly_revenue, count(transaction_id) AS total_orders
{POS} GROUP BY year, month ORDER BY year, month""",
        "rpt_top_categories": f"""{s}
SELECT category, {rmoney(nr, 2)} AS total_revenue, count(transaction_id) AS total_orders,
       {mpct('sum(discount_pct)', 'count(discount_pct)', 2)} AS avg_discount_pct
{POS} GROUP BY category ORDER BY total_revenue DESC, category NULLS LAST LIMIT 5""",
        "rpt_regional": f"""{s}
SELECT region, {rmoney(nr, 2)} AS total_revenue, count(transaction_id) AS total_orders,
       {pct(RET, 'count(*)', 2)} AS return_rate_pct
FROM sales GROUP BY region ORDER BY total_revenue DESC, region""",
        "rpt_top_products_units": f"""{s}
SELECT product_name, category, CAST(sum(quantity) AS BIGINT) AS units_sold, {rmoney(nr, 2)} AS total_revenue
{POS} GROUP BY product_name, category ORDER BY units_sold DESC, product_name NULLS LAST, category NULLS LAST LIMIT 10""",
        "rpt_payment_share": f"""{s}
SELECT payment_method, count(*) AS num_transactions,
       {pct('count(*)', '(SELECT count(*) FROM sales)', 2)} AS pct_share
FROM sales GROUP BY payment_method ORDER BY num_transactions DESC, payment_method""",
        "rpt_day_type": f"""{s}
SELECT {DAY_TYPE} AS day_type, count(transaction_id) AS total_orders, {rmoney(nr, 2)} AS total_revenue,
       {mmoney(nr, 'count(net_revenue)', 2)} AS avg_order_value
{POS} GROUP BY day_type""",
        "rpt_buckets": f"""{s}
SELECT revenue_bucket, count(*) AS num_transactions, {rmoney(nr, 2)} AS total_revenue,
       {mmoney(nr, 'count(net_revenue)', 2)} AS avg_order_value
{POS} GROUP BY revenue_bucket ORDER BY avg_order_value DESC, revenue_bucket""",
        # D1-D13
        "dash_kpis": f"""{s}
SELECT count(transaction_id) AS total_orders, {rmoney(nr, 0)} AS total_revenue,
       {mmoney(nr, 'count(net_revenue)', 0)} AS avg_order_value, {pct(RET, 'count(*)', 1)} AS return_rate
FROM sales""",
        "dash_monthly": f"""{s}
SELECT year, month, {rmoney(nr, 0)} AS revenue, count(*) AS orders,
       lpad(CAST(month AS VARCHAR), 2, '0') || '/' || CAST(year AS VARCHAR) AS period
{POS} GROUP BY year, month ORDER BY year, month""",
        "dash_category": f"""{s}
SELECT category, {rmoney(nr, 0)} AS revenue {POS} GROUP BY category ORDER BY revenue DESC, category""",
        "dash_payment": f"""{s}
SELECT payment_method, count(*) AS txns FROM sales GROUP BY payment_method ORDER BY txns DESC, payment_method""",
        "dash_day_type": f"""{s}
SELECT {DAY_TYPE} AS day_type, count(*) AS orders, {rmoney(nr, 0)} AS revenue {POS} GROUP BY day_type""",
        "dash_category_list": f"""{s}
SELECT DISTINCT category FROM sales ORDER BY category""",
        "dash_top_products": f"""{s}
SELECT product_name, category, CAST(sum(quantity) AS BIGINT) AS units_sold, {rmoney(nr, 0)} AS total_revenue,
       {mpct('sum(discount_pct)', 'count(discount_pct)', 1)} AS avg_discount
{POS} GROUP BY product_name, category ORDER BY total_revenue DESC, product_name NULLS LAST, category NULLS LAST LIMIT 15""",
        "dash_top_products_cat": f"""{s}
SELECT product_name, category, CAST(sum(quantity) AS BIGINT) AS units_sold, {rmoney(nr, 0)} AS total_revenue,
       {mpct('sum(discount_pct)', 'count(discount_pct)', 1)} AS avg_discount
FROM sales WHERE category = 'Economy' AND net_revenue > 0
GROUP BY product_name, category ORDER BY total_revenue DESC, product_name NULLS LAST, category NULLS LAST LIMIT 15""",
        "dash_discount_scatter": f"""{s}
SELECT product_name, category, {mpct('sum(discount_pct)', 'count(discount_pct)', 1)} AS avg_discount,
       {rmoney(nr, 0)} AS total_revenue, CAST(sum(quantity) AS BIGINT) AS units_sold
{POS} GROUP BY product_name, category""",
        "dash_buckets": f"""{s}
SELECT revenue_bucket, count(*) AS txns, {rmoney(nr, 0)} AS revenue
{POS} GROUP BY revenue_bucket ORDER BY revenue DESC, revenue_bucket""",
        "dash_regional": f"""{s}
SELECT region, {rmoney(nr, 0)} AS total_revenue, count(*) AS total_orders,
       {mmoney(nr, 'count(net_revenue)', 0)} AS avg_order_value, {pct(RET, 'count(*)', 1)} AS return_rate
FROM sales GROUP BY region ORDER BY total_revenue DESC, region""",
        "dash_heat_long": f"""{s}
SELECT region, category, {rmoney(nr, 0)} AS revenue {POS} GROUP BY region, category""",
        "dash_heat_pivot": f"""{s}, h AS (
  SELECT region, category, {rmoney(nr, 0)} AS revenue {POS} GROUP BY region, category)
SELECT region,
       coalesce(sum(revenue) FILTER (WHERE category = 'Economy'), 0) AS "Economy",
       coalesce(sum(revenue) FILTER (WHERE category = 'Large'), 0) AS "Large",
       coalesce(sum(revenue) FILTER (WHERE category = 'Medium'), 0) AS "Medium",
       coalesce(sum(revenue) FILTER (WHERE category = 'Promo'), 0) AS "Promo",
       coalesce(sum(revenue) FILTER (WHERE category = 'Small'), 0) AS "Small",
       coalesce(sum(revenue) FILTER (WHERE category = 'Standard'), 0) AS "Standard"
FROM h GROUP BY region ORDER BY region""",
        # N1-N6
        "q_region_return": f"""{s}
SELECT region, {RET} AS returns, count(*) AS total_orders, {pct(RET, 'count(*)', 2)} AS return_rate_pct
FROM sales GROUP BY region
ORDER BY CAST({RET} AS DOUBLE) / count(*) DESC, region NULLS LAST LIMIT 1""",
        "q_region_return_quarter": f"""{s}
SELECT region, {RET} AS returns, count(*) AS total_orders, {pct(RET, 'count(*)', 2)} AS return_rate_pct
FROM sales WHERE quarter = 3 GROUP BY region
ORDER BY CAST({RET} AS DOUBLE) / count(*) DESC, region NULLS LAST LIMIT 1""",
        "q_top_products_in_category": f"""{s}
SELECT product_name, category, {rmoney(nr, 2)} AS total_revenue
FROM sales WHERE net_revenue > 0 AND category = 'Economy'
GROUP BY product_name, category ORDER BY sum(net_revenue) DESC, product_name NULLS LAST LIMIT 3""",
        "q_monthly_in_quarter": f"""{s}
SELECT year, month, {rmoney(nr, 2)} AS monthly_revenue, count(transaction_id) AS total_orders
FROM sales WHERE net_revenue > 0 AND year = 1997 AND quarter = 3
GROUP BY year, month ORDER BY year, month""",
        "q_weekend_payment": f"""{s}
SELECT payment_method, count(*) AS num_transactions FROM sales
WHERE weekday IN ('Saturday', 'Sunday') GROUP BY payment_method
ORDER BY num_transactions DESC, payment_method NULLS LAST LIMIT 1""",
        "q_premium_share": f"""{s}
SELECT count(*) FILTER (WHERE revenue_bucket = 'Premium') AS premium_orders, count(*) AS total_orders,
       {pct("count(*) FILTER (WHERE revenue_bucket = 'Premium')", 'count(*)', 2)} AS premium_share_pct
FROM sales""",
    }


def _adhoc() -> dict[str, str]:
    from salesengine.plans.registry import ADHOC_SQL  # the same text runs in Spark

    body = ADHOC_SQL.replace(":category", "'Economy'")
    return {"adhoc_sql": f"{WITH_SALES} SELECT region, CAST(orders AS BIGINT) AS orders, "
                         f"CAST(returns AS BIGINT) AS returns FROM ({body}) t"}


def _csv_losses() -> str:
    """The rules of ``registry.broken_lines`` counted: a broken quote hides the other faults of its line."""
    quote, many, few = "_ord_part % 17 = 0", "_ord_part % 17 <> 0 AND _ord_part % 7 = 0", "_ord_part % 17 <> 0 AND _ord_part % 7 <> 0 AND _ord_part % 11 = 0"
    counts = [("records", None, "TRUE"), ("sound", None, "_ord_part % 17 <> 0 AND _ord_part % 7 <> 0 AND _ord_part % 11 <> 0"),
              ("too_many_fields", None, many), ("too_few_fields", None, few), ("open_quote", None, quote)]
    counts += [("lost_value", c, "FALSE") for c in ("quantity", "discount_pct", "final_amount", "is_returned")]
    counts += [("lost_value", "unit_price", "_ord_part % 17 <> 0 AND _ord_part % 7 <> 0 AND _ord_part % 13 = 0")]
    rows = [f"SELECT '{w}' AS what, {'CAST(NULL AS VARCHAR)' if c is None else repr(c)} AS column_name, count(*) FILTER ({cond}) AS n FROM raw" for w, c, cond in counts]
    return f"WITH {RAW} " + " UNION ALL ".join(rows)


def report_sql(sales_cte: str) -> dict[str, str]:
    """The report statements over another ``sales`` definition (tests)."""
    return _report_queries(sales_cte)


def oracle_sql() -> dict[str, str]:
    out = {}
    out.update(_clean_queries())
    out.update(_report_queries())
    out.update(_adhoc())
    # the same results by another path: from CSV files, or read back from written tables
    out["csv_clean_sales"] = out["fact_table"] = out["clean_sales"]
    name = "'\"' || product_name || '\",' || chr(10) || chr(10) || product_name || chr(10) || '\"x'"
    out["csv_quoted_breaks"] = f"SELECT * REPLACE ({name} AS product_name) FROM ({out['clean_sales']}) c"
    out["csv_losses"] = _csv_losses()
    out["status_counts"] = out["quality_counts"]
    for name in ("monthly_category_summary", "regional_summary", "product_summary"):
        out[f"written_{name}"] = out[name]
    out["written_refreshed_sales"] = out["clean_sales"]
    out["clean_dedupe_suspects"] = out["clean_dedupe"]
    out["versioned_product_summary"] = out["product_summary"]
    out["cached_adhoc_sql"] = out["adhoc_sql"]
    returned = "count(*) FILTER (WHERE is_returned)"
    out["ask_region_quarter"] = f"""{WITH_SALES}
SELECT region, quarter, count(transaction_id) AS orders, {rmoney('sum(net_revenue)', 2)} AS revenue, {mmoney('sum(net_revenue)', 'count(net_revenue)', 2)} AS mean_order_value,
       {pct(returned, 'count(*)', 2)} AS return_rate_pct, strftime(min(date), '%Y-%m-%d') AS first_date
FROM sales WHERE category IN ('Economy', 'Promo') AND year >= 1997 GROUP BY region, quarter"""
    out["ask_weekday"] = f"""{WITH_SALES}
SELECT weekday, count(*) AS n, {rmoney('sum(net_revenue)', 2)} AS revenue, CAST(sum(quantity) AS BIGINT) AS units, {mpct('sum(discount_pct)', 'count(discount_pct)', 2)} AS discount
FROM sales WHERE NOT is_returned GROUP BY weekday"""
    out["adhoc_regional_summary"] = out["regional_summary"]
    return out
