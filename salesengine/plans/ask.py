"""Grouped questions, answered from the smallest table that holds what they need.

A question names its keys, measures and filters; each measure is made of additive columns that both
rollups and the fact table have. If a rollup has every key and filter column and every column of the
measures, its rows, added up, give the same answer as the fact table's rows, so it is read
instead: the product rollup if it can, then the sales rollup, else the fact table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_type
from ..functions.rounding import mean_money, mean_percent, percent, round_money
from ..operators import rollup as R


@dataclass(frozen=True)
class Measure:
    needs: tuple[str, ...]
    value: Column


def catalogue() -> dict[str, Measure]:
    """The measures by name, with the columns that they add up."""
    revenue, flags, price = ("sum_revenue",), ("n_rows", "is_returned"), ("sum_revenue", "n_revenue")
    return {
        "rows": Measure(("n_rows",), R.rows()),
        "orders": Measure(("n_ids",), R.ids()),
        "revenue": Measure(revenue, round_money(R.revenue(), 2)),
        "revenue_rounded": Measure(revenue, round_money(R.revenue(), 0)),
        "mean_order_value": Measure(price, mean_money(R.revenue(), R.revenue_count(), 2)),
        "units": Measure(("sum_quantity",), R.quantity()),
        "mean_discount_pct": Measure(("sum_discount", "n_discount"), mean_percent(R.discount(), R.discount_count(), 2)),
        "returns": Measure(flags, R.returned()),
        "return_rate_pct": Measure(flags, percent(R.returned(), R.rows(), 2)),
        "first_date": Measure(("min_date",), F.date_format(F.min("min_date"), "yyyy-MM-dd")),
        "last_date": Measure(("max_date",), F.date_format(F.max("max_date"), "yyyy-MM-dd")),
    }


def detailed(sales: DataFrame) -> DataFrame:
    """The fact table with the rollups' keys and measures beside its own columns."""
    own = R.row_measures(sales)
    added = {"day_type": day_type(F.col("weekday")), "has_revenue": F.col("net_revenue") > 0, "n_rows": F.lit(1).cast("long"),
             "n_ids": F.col("transaction_id").isNotNull().cast("long"), "n_revenue": F.col("net_revenue").isNotNull().cast("long"), "sum_revenue": F.col("net_revenue"),
             "n_discount": F.col("discount_pct").isNotNull().cast("long"), "sum_discount": F.col("discount_pct"),
             "sum_quantity": F.col("quantity").cast("long"), "min_date": F.col("date"), "max_date": F.col("date")}
    assert set(added) | set(sales.columns) >= set(own.columns)
    return sales.withColumns(added)


def _condition(column: str, wanted) -> Column:
    """``column`` is the value, is in the list, or is between the two of a tuple (None: open); None alone asks for nulls."""
    c = F.col(f"`{column}`")
    if wanted is None:
        return c.isNull()
    if isinstance(wanted, tuple):
        low, high = wanted
        return (F.lit(True) if low is None else c >= F.lit(low)) & (F.lit(True) if high is None else c <= F.lit(high))
    if isinstance(wanted, (list, set, frozenset)):
        return c.isin(*[F.lit(v) for v in wanted])
    return c == F.lit(wanted)


def source_for(tables: Mapping[str, DataFrame], needed: set[str]) -> str:
    """Name of the smallest table with all ``needed`` columns: product_rollup, sales_rollup or sales."""
    for name in ("product_rollup", "sales_rollup"):
        if name in tables and needed <= set(tables[name].columns):
            return name
    absent = needed - set(detailed(tables["sales"]).columns)
    if absent:
        raise ValueError(f"no column {', '.join(sorted(absent))}")
    return "sales"


def ask(tables: Mapping[str, DataFrame], measures: Sequence[str] | Mapping[str, str], by: Sequence[str] = (), where: Mapping[str, object] | None = None,
        order: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """One row a group of ``by`` (one in all without keys), with its ``measures``.

    ``tables`` are those of ``open_tables``. ``measures`` names some of the ``catalogue``, or maps column names of the
    result to them. ``where`` maps columns to a value, a list of values, a (low, high) tuple or None, as
    ``_condition`` says; all must hold, and a null passes none but None. ``order`` lists result columns, with ``-`` before one for falling
    order, nulls last either way. Keys and filters may be any column of the fact table, and
    ``day_type`` or ``has_revenue``.
    """
    known, where = catalogue(), where or {}
    named = measures if isinstance(measures, Mapping) else {m: m for m in measures}
    unknown = [m for m in named.values() if m not in known]
    if unknown:
        raise ValueError(f"no measure {', '.join(unknown)}; there are {', '.join(known)}")
    needed = {*by, *where, *(c for m in named.values() for c in known[m].needs)}
    name = source_for(tables, needed)
    rows = detailed(tables[name]) if name == "sales" else tables[name]
    for column, wanted in where.items():
        rows = rows.where(_condition(column, wanted))
    out = rows.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*[known[m].value.alias(alias) for alias, m in named.items()])
    if order:
        out = out.orderBy(*[F.col(f"`{c[1:]}`").desc_nulls_last() if c.startswith("-") else F.col(f"`{c}`").asc_nulls_last() for c in order])
    return out if limit is None else out.limit(limit)
