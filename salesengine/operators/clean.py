"""T1-T11 — the cleaning job, one DataFrame -> DataFrame function per step.

Order matters (T1 runs before T2, so a key whose first copy has a bad date
disappears). Only T1 is a wide operation; T2-T9 are narrow projections and
filters that fuse into one whole-stage-codegen span after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_iso_date, weekday_name
from ..functions.text import normalise
from ..schema import (
    BUCKET_EDGES,
    BUCKET_LABELS,
    BUCKET_NONE,
    MONEY,
    RATIO,
    SALES,
    SALES_COLUMNS,
)

KEY = "transaction_id"


# --- T1 ----------------------------------------------------------------------
def _first_per_key(df: DataFrame, order_cols: Sequence[str], payload: Sequence[str], copies: bool) -> DataFrame:
    """One row per key: the payload of the copy that sorts first on order_cols,
    ties by the payload itself, so the survivor never depends on the partitioning.

    Expressed as ``min`` of one struct in a GROUP BY rather than ``row_number`` over a
    window: the aggregate runs a partial (map-side) step first, so each task
    ships at most one row per key to the shuffle. A key that holds a third of
    all rows (e.g. a null id in dirty input) therefore costs one row per map
    task instead of landing entirely in one reducer, and duplicates never cross
    the network. Null keys form one group, so exactly one null-id row survives.
    """
    aggs = [F.min(F.struct(*order_cols, *payload)).alias("_first")]
    if copies:
        aggs.append(F.count(F.lit(1)).alias("_copies"))
    out = df.groupBy(KEY).agg(*aggs)
    cols = [F.col(KEY)] + [F.col(f"_first.{c}").alias(c) for c in payload]
    if copies:
        cols.append(F.col("_copies"))
    return out.select(*cols)


def dedupe_first(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """Keep the first row of every transaction_id (first in ``order_cols``)."""
    payload = [c for c in df.columns if c != KEY and c not in order_cols]
    return _first_per_key(df, order_cols, payload, copies=False)


#: Suspected keys are broadcast up to this many (16 bytes each), else T1 takes its usual path.
SUSPECT_LIMIT = 4_000_000


def suspected_keys(df: DataFrame) -> DataFrame:
    """(_h long): hashes of the transaction ids that more than one row may have; every id that occurs twice is among
    them, others only by a collision of the hash. Shuffles the hashes alone, combined in the map tasks."""
    return df.select(F.xxhash64(KEY).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h")


def _first_of_suspects(df: DataFrame, order_cols: Sequence[str], payload: Sequence[str], copies: bool, suspects: DataFrame) -> DataFrame:
    """``_first_per_key`` that shuffles the rows of ``suspects`` (a broadcast) only; all others have an id of their own."""
    known = F.broadcast(suspects)
    hashed = df.withColumn("_h", F.xxhash64(KEY))
    once = hashed.join(known, "_h", "left_anti").select(KEY, *payload, *([F.lit(1).cast("long").alias("_copies")] if copies else []))
    again = _first_per_key(hashed.join(known, "_h", "left_semi").drop("_h"), order_cols, payload, copies)
    return once.unionByName(again)


def dedupe_suspects(df: DataFrame, order_cols: Sequence[str], suspects: DataFrame, limit: int = SUSPECT_LIMIT) -> DataFrame:
    """T1 for input of mostly unique ids: equal to ``dedupe_first``, but rows whose id is surely unique are neither
    shuffled nor sorted.

    ``suspects`` are the ``suspected_keys`` of ``df``, written to a table (its rows are counted here, and read by every task).
    Beyond ``limit`` of them this is ``dedupe_first``. ``df`` is scanned twice more, by
    its one column and then in two branches, so it should be a table of a columnar format.
    """
    payload = [c for c in df.columns if c != KEY and c not in order_cols]
    if suspects.limit(limit + 1).count() > limit:
        return dedupe_first(df, order_cols)
    return _first_of_suspects(df, order_cols, payload, False, suspects)


# --- T2 ----------------------------------------------------------------------
def parse_dates(df: DataFrame) -> DataFrame:
    """ISO text -> DATE; rows whose date does not parse are dropped."""
    return df.withColumn("date", parse_iso_date(F.col("date"))).filter(F.col("date").isNotNull())


# --- T3 / T4 -------------------------------------------------------------------
def add_calendar(df: DataFrame) -> DataFrame:
    """Year, month, quarter and the full English weekday name."""
    d = F.col("date")
    return df.withColumns(
        {"year": F.year(d), "month": F.month(d), "quarter": F.quarter(d), "weekday": weekday_name(d)}
    )


# --- T5 ----------------------------------------------------------------------
def bad_price(unit_price: Column, final_amount: Column) -> Column:
    """True when the price is not positive or the amount negative; a missing
    value never makes a row bad (comparisons with null count as false)."""
    return F.coalesce((unit_price <= 0) | (final_amount < 0), F.lit(False))


def drop_bad_prices(df: DataFrame) -> DataFrame:
    """T5: drop rows with unit_price <= 0 or final_amount < 0."""
    return df.filter(~bad_price(F.col("unit_price"), F.col("final_amount")))


# --- T6 ----------------------------------------------------------------------
def clip_discount(df: DataFrame) -> DataFrame:
    """Clip discount_pct to [0, 1]; null stays null (least/greatest would
    turn it into a bound)."""
    d = F.col("discount_pct")
    clipped = F.when(d < 0, F.lit(0)).when(d > 1, F.lit(1)).otherwise(d)
    return df.withColumn("discount_pct", clipped.try_cast(RATIO))


# --- T7 ----------------------------------------------------------------------
def add_net_revenue(df: DataFrame) -> DataFrame:
    """0 for returned rows, else final_amount. A missing flag counts as
    returned (a missing value is truthy)."""
    nr = F.when(F.coalesce(F.col("is_returned"), F.lit(True)), F.lit(0)).otherwise(F.col("final_amount"))
    return df.withColumn("net_revenue", nr.try_cast(MONEY))


# --- T8 ----------------------------------------------------------------------
def normalise_text(df: DataFrame, cols: Sequence[str] = ("category", "region")) -> DataFrame:
    """Trim and title-case the given text columns."""
    return df.withColumns({c: normalise(F.col(c)) for c in cols})


# --- T9 ----------------------------------------------------------------------
def revenue_bucket(amount: Column) -> Column:
    """Right-closed bins over BUCKET_EDGES; outside every bin -> BUCKET_NONE."""
    e = F.when(amount.isNull() | (amount <= BUCKET_EDGES[0]), F.lit(BUCKET_NONE))
    for edge, label in zip(BUCKET_EDGES[1:], BUCKET_LABELS[:-1]):
        e = e.when(amount <= edge, F.lit(label))
    return e.otherwise(F.lit(BUCKET_LABELS[-1]))


def add_revenue_bucket(df: DataFrame) -> DataFrame:
    """revenue_bucket from final_amount."""
    return df.withColumn("revenue_bucket", revenue_bucket(F.col("final_amount")))


# --- T10 -----------------------------------------------------------------------
def fact_columns() -> list[Column]:
    """The fact table's columns, numbers narrowed to its types (null where they don't fit)."""
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in SALES.fields]


def clean_sales(raw: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """T1 -> T2 -> T3/T4 -> T5 -> T6 -> T7 -> T8 -> T9, SALES columns: the ``ok`` rows of ``clean_with_status``."""
    return clean_with_status(raw, order_cols).filter(F.col(STATUS) == OK).select(*SALES_COLUMNS)


STATUS = "dq_status"
COPIES = "dq_copies"
RAW_DATE = "dq_raw_date"
OK, BAD_DATE, BAD_PRICE = "ok", "bad_date", "bad_price"


def clean_with_status(raw: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """T10 without dropping: every first-per-key row, with its ``dq_status``
    (``ok`` / ``bad_date`` / ``bad_price``, decided in T2-then-T5 order) and
    ``dq_copies`` (rows sharing its key). The ``ok`` rows are ``clean_sales``;
    the rest is what T2 and T5 drop, with the date as it was in ``dq_raw_date``.

    Writing this once (partitioned by status) gives the fact table and the
    T11 counters from one pass over the raw input.
    """
    payload = [c for c in raw.columns if c != KEY and c not in order_cols]
    first = _first_per_key(raw, order_cols, payload, copies=True).withColumnRenamed("_copies", COPIES)
    d = first.withColumn(RAW_DATE, F.col("date")).withColumn("date", parse_iso_date(F.col("date")))
    status = (
        F.when(F.col("date").isNull(), F.lit(BAD_DATE))
        .when(bad_price(F.col("unit_price"), F.col("final_amount")), F.lit(BAD_PRICE))
        .otherwise(F.lit(OK))
    )
    return (
        d.withColumn(STATUS, status)
        .withColumn(RAW_DATE, F.when(F.col(STATUS) != OK, F.col(RAW_DATE)))
        .transform(add_calendar)
        .transform(clip_discount)
        .transform(add_net_revenue)
        .transform(normalise_text)
        .transform(add_revenue_bucket)
        .select(*fact_columns(), COPIES, RAW_DATE, STATUS)
    )


def status_counts(staged: DataFrame) -> DataFrame:
    """T11 from a ``clean_with_status`` result (reads two narrow columns)."""
    st = F.col(STATUS)
    return staged.agg(
        F.sum(COPIES).alias("raw_rows"),
        (F.sum(COPIES) - F.count(F.lit(1))).alias("duplicates"),
        F.count_if(st == BAD_DATE).alias("bad_dates"),
        F.count_if(st == BAD_PRICE).alias("bad_prices"),
        F.count_if(st == OK).alias("clean_rows"),
    )


# --- T11 -----------------------------------------------------------------------
def quality_counts(raw: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """One row of data-quality counters, each over the survivors of the
    previous step: raw_rows - duplicates - bad_dates - bad_prices = clean_rows.

    Only the columns the checks read go through the dedupe shuffle.
    """
    first = _first_per_key(raw, order_cols, ["date", "unit_price", "final_amount"], copies=True)
    date_ok = parse_iso_date(F.col("date")).isNotNull()
    price_bad = bad_price(F.col("unit_price"), F.col("final_amount"))
    return first.agg(
        F.sum("_copies").alias("raw_rows"),
        (F.sum("_copies") - F.count(F.lit(1))).alias("duplicates"),
        F.count_if(~date_ok).alias("bad_dates"),
        F.count_if(date_ok & price_bad).alias("bad_prices"),
        F.count_if(date_ok & ~price_bad).alias("clean_rows"),
    )
