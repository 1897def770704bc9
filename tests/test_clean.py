"""Unit tests for the cleaning steps T1-T11 on tiny frames (edge rows)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesengine.operators import clean as C
from salesengine.schema import RAW_SALES, SALES_COLUMNS

ORDER = ["_o"]
SCHEMA = T.StructType(RAW_SALES.fields + [T.StructField("_o", T.IntegerType())])

BASE = {
    "transaction_id": "TXN1",
    "date": "2023-01-07",
    "product_name": "Yoga Mat",
    "category": "Sports",
    "region": "North",
    "quantity": 1,
    "unit_price": Decimal("10.00"),
    "discount_pct": Decimal("0.1000"),
    "final_amount": Decimal("10.00"),
    "payment_method": "UPI",
    "is_returned": False,
}


def raw(spark, *rows):
    out = []
    for i, r in enumerate(rows):
        d = dict(BASE)
        d.update(r)
        d["_o"] = i
        out.append(tuple(d[f.name] for f in SCHEMA.fields))
    return spark.createDataFrame(out, SCHEMA)


def col(df, name):
    return [r[0] for r in df.orderBy("_o").select(name).collect()] if "_o" in df.columns else [
        r[0] for r in df.select(name).collect()
    ]


# --- T1 ------------------------------------------------------------------------
def test_dedupe_keeps_first_in_order(spark):
    df = raw(spark, {"final_amount": Decimal("1.00")}, {"final_amount": Decimal("2.00")},
             {"transaction_id": "TXN2", "final_amount": Decimal("3.00")})
    out = C.dedupe_first(df, ORDER)
    got = {r.transaction_id: r.final_amount for r in out.collect()}
    assert got == {"TXN1": Decimal("1.00"), "TXN2": Decimal("3.00")}


def test_dedupe_first_wins_regardless_of_input_order(spark):
    # The later row comes first in the data but has a larger order value.
    df = raw(spark, {"final_amount": Decimal("1.00")}, {"final_amount": Decimal("2.00")})
    flipped = df.withColumn("_o", 10 - F.col("_o")).orderBy(F.desc("_o")).repartition(3)
    got = [r.final_amount for r in C.dedupe_first(flipped, ORDER).collect()]
    assert got == [Decimal("2.00")]


def test_dedupe_null_ids_keep_one(spark):
    df = raw(spark, {"transaction_id": None, "final_amount": Decimal("5.00")},
             {"transaction_id": None, "final_amount": Decimal("6.00")})
    rows = C.dedupe_first(df, ORDER).collect()
    assert len(rows) == 1 and rows[0].final_amount == Decimal("5.00")


def test_dedupe_then_bad_date_drops_key(spark):
    # First copy has a bad date, second a good one: the id disappears.
    df = raw(spark, {"date": "2023-02-30"}, {"date": "2023-01-01"})
    assert C.clean_sales(df, ORDER).count() == 0


# --- T2 ------------------------------------------------------------------------
KEPT = ["2023-01-01", "2023-1-2", "2024-02-29"]
DROPPED = ["2023-02-30", "01/05/2023", "2023-01-03 10:00:00", " 2023-01-06", "20230104", "2023-01",
           "2023-001-01", "", None, "1500-01-01", "2023-04-31", "2023-13-01", "2023-00-10", "2023-02-29",
           "2023-01-01 ", "2023-01-01T00:00", "0000-01-01", "9999-12-31"]


def test_parse_dates_keeps_and_drops(spark):
    rows = [{"transaction_id": f"T{i}", "date": d} for i, d in enumerate(KEPT + DROPPED)]
    out = C.parse_dates(raw(spark, *rows))
    got = sorted(r.date for r in out.collect())
    assert got == [dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2024, 2, 29)]


# --- T3 / T4 -------------------------------------------------------------------
def test_calendar_parts(spark):
    r = C.add_calendar(C.parse_dates(raw(spark, {}))).collect()[0]
    assert (r.year, r.month, r.quarter, r.weekday) == (2023, 1, 1, "Saturday")


# --- T5 ------------------------------------------------------------------------
def test_price_filter_null_is_kept(spark):
    rows = [
        {"transaction_id": "drop1", "unit_price": Decimal("0")},
        {"transaction_id": "drop2", "unit_price": Decimal("-1")},
        {"transaction_id": "drop3", "final_amount": Decimal("-0.01")},
        {"transaction_id": "keep1", "unit_price": None},
        {"transaction_id": "keep2", "final_amount": None},
        {"transaction_id": "keep3", "final_amount": Decimal("0")},
        {"transaction_id": "drop4", "unit_price": None, "final_amount": Decimal("-1")},
    ]
    got = sorted(r.transaction_id for r in C.drop_bad_prices(raw(spark, *rows)).collect())
    assert got == ["keep1", "keep2", "keep3"]


# --- T6 ------------------------------------------------------------------------
def test_clip_discount(spark):
    vals = [Decimal("-0.2"), Decimal("0.3"), Decimal("1.7"), None]
    df = raw(spark, *[{"discount_pct": v} for v in vals])
    assert col(C.clip_discount(df), "discount_pct") == [Decimal("0"), Decimal("0.3"), Decimal("1"), None]


# --- T7 ------------------------------------------------------------------------
def test_net_revenue(spark):
    df = raw(spark, *[{"is_returned": v} for v in (True, False, None)])
    assert col(C.add_net_revenue(df), "net_revenue") == [Decimal("0"), Decimal("10"), Decimal("0")]


# --- T8 ------------------------------------------------------------------------
def test_title_case(spark):
    ins = [" hOME & kITCHEN ", "t-shirt x", "5kg rice", "o'neil", "\tnorth\n", None, "middle east", "   "]
    outs = ["Home & Kitchen", "T-Shirt X", "5Kg Rice", "O'Neil", "North", None, "Middle East", ""]
    df = raw(spark, *[{"category": v, "region": v} for v in ins])
    out = C.normalise_text(df)
    assert col(out, "category") == outs
    assert col(out, "region") == outs


# --- T9 ------------------------------------------------------------------------
def test_revenue_bucket_edges(spark):
    vals = ["0", "0.01", "500", "500.01", "1500", "1500.01", "5000", "5000.01", None]
    want = ["nan", "Low", "Low", "Medium", "Medium", "High", "High", "Premium", "nan"]
    df = raw(spark, *[{"final_amount": Decimal(v) if v else None} for v in vals])
    assert col(C.add_revenue_bucket(df), "revenue_bucket") == want


# --- T10 / T11 -----------------------------------------------------------------
def test_clean_sales_schema_and_idempotent_dedupe(spark):
    df = raw(spark, {}, {"transaction_id": "TXN2", "category": " sPORTS "})
    out = C.clean_sales(df, ORDER)
    assert out.columns == SALES_COLUMNS
    assert sorted(r.category for r in out.collect()) == ["Sports", "Sports"]


def test_quality_counts_add_up(spark):
    rows = [
        {"transaction_id": "A"}, {"transaction_id": "A"},            # 1 duplicate
        {"transaction_id": "B", "date": "bad"},                       # bad date
        {"transaction_id": "C", "unit_price": Decimal("0")},          # bad price
        {"transaction_id": "D"}, {"transaction_id": "E", "date": None},
    ]
    df = raw(spark, *rows)
    q = C.quality_counts(df, ORDER).collect()[0]
    assert (q.raw_rows, q.duplicates, q.bad_dates, q.bad_prices, q.clean_rows) == (6, 1, 2, 1, 2)
    assert q.raw_rows - q.duplicates - q.bad_dates - q.bad_prices == q.clean_rows
    assert C.clean_sales(df, ORDER).count() == q.clean_rows


@pytest.mark.parametrize("parts", [1, 4])
def test_clean_independent_of_partitioning(spark, parts):
    rows = [{"transaction_id": f"T{i % 7}", "final_amount": Decimal(i)} for i in range(40)]
    df = raw(spark, *rows)
    a = sorted(map(tuple, C.clean_sales(df, ORDER).collect()))
    b = sorted(map(tuple, C.clean_sales(df.repartition(parts), ORDER).collect()))
    assert a == b


def test_clean_is_idempotent(spark):
    from salesengine.operators.generate import generate_sales
    from salesengine.schema import RAW_COLUMNS

    raw = generate_sales(spark, 2000).withColumn("_o", F.lit(0))
    once = C.clean_sales(raw, ORDER)
    again_raw = once.withColumn("date", F.date_format("date", "yyyy-MM-dd")).select(*RAW_COLUMNS)
    twice = C.clean_sales(again_raw.withColumn("_o", F.lit(0)), ORDER)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_shuffle_shape_keeps_blocks_large_at_any_size():
    from salesengine.session import shuffle_shape

    assert shuffle_shape(10) == (128 << 20, 1)
    assert shuffle_shape(100 << 30)[1] == 100
    for size in (1 << 40, 100 * 10**12):
        split, partitions = shuffle_shape(size)
        assert size / (size / split) / partitions >= 100_000


def test_sized_for_raises_only_and_restores(spark):
    from salesengine.session import INITIAL_PARTITIONS, SPLIT_BYTES, sized_for

    before = [spark.conf.get(k, None) for k in (INITIAL_PARTITIONS, SPLIT_BYTES)]
    with sized_for(spark, 100 * 10**12):
        assert int(spark.conf.get(INITIAL_PARTITIONS)) > 10_000
        assert int(spark.conf.get(SPLIT_BYTES)) > 1 << 30
    assert [spark.conf.get(k, None) for k in (INITIAL_PARTITIONS, SPLIT_BYTES)] == before


def test_tied_order_does_not_depend_on_partitioning(spark):
    rows = spark.range(20_000).selectExpr("cast(id % 50 as string) AS transaction_id", "0 AS _o", "cast(id AS string) AS v")
    kept = [sorted(map(tuple, C.dedupe_first(rows.repartition(n, "v"), ["_o"]).collect())) for n in (1, 3, 7)]
    assert kept[0] == kept[1] == kept[2]


def test_dates_with_line_breaks_are_rejected(spark):
    from salesengine.functions.dates import parse_iso_date

    df = spark.createDataFrame([(x,) for x in ("2023-01-01", "2023-01-01\n", "2023-01-01\r\n", "\n2023-01-01")], "d string")
    assert [r[0] is None for r in df.select(parse_iso_date(F.col("d"))).collect()] == [False, True, True, True]


def test_title_case_after_uncased_characters(spark):
    from salesengine.functions.text import title_case

    texts = ["\u4e2da", "\u2177x", "a\u4e2dBC", "\u00aaX", "\u01c5AB", "o'neil 5kg", "\u05d0z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(title_case(F.col("t"))).collect()] == [t.title() for t in texts]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_aggregates_before_the_shuffle(spark):
    plan = _plan(C.dedupe_first(raw(spark, {}, {}), ORDER))
    partial = plan.index("partial_min(struct(")
    exchange = plan.index("Exchange hashpartitioning(transaction_id")
    # Printed top-down: the exchange sits above (before) the partial aggregate.
    assert exchange < partial


def test_hot_key_third_of_rows(spark):
    # One id holds a third of all rows, spread over every input partition.
    rows = [{"transaction_id": "HOT" if i % 3 == 0 else f"T{i}", "final_amount": Decimal(i)} for i in range(3000)]
    df = raw(spark, *rows).repartition(6)
    out = C.dedupe_first(df, ORDER)
    hot = out.filter("transaction_id = 'HOT'").collect()
    assert len(hot) == 1 and hot[0].final_amount == Decimal(0)
    assert out.count() == 1 + 2000


def test_fact_write_is_rebalanced(spark):
    from salesengine.sources.tables import rebalanced_for_write

    sales = C.clean_sales(raw(spark, {}), ORDER)
    plan = rebalanced_for_write(sales)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions [year" in plan


def test_status_split_matches_clean_and_counters(spark):
    rows = [
        {"transaction_id": "A"}, {"transaction_id": "A"},
        {"transaction_id": "B", "date": "bad"},
        {"transaction_id": "C", "unit_price": Decimal("0")},
        {"transaction_id": "D"}, {"transaction_id": "E", "date": None},
        {"transaction_id": "F", "date": "2023-02-30"}, {"transaction_id": "F", "date": "2023-01-01"},
    ]
    df = raw(spark, *rows)
    staged = C.clean_with_status(df, ORDER)
    ok = staged.filter(F.col(C.STATUS) == C.OK).select(*SALES_COLUMNS)
    assert sorted(map(tuple, ok.collect())) == sorted(map(tuple, C.clean_sales(df, ORDER).collect()))
    a = C.status_counts(staged).collect()[0].asDict()
    b = C.quality_counts(df, ORDER).collect()[0].asDict()
    assert a == b == {"raw_rows": 8, "duplicates": 2, "bad_dates": 3, "bad_prices": 1, "clean_rows": 2}


@pytest.mark.parametrize("value", [
    "ǆemal", "ﬁne", "a  b", "ÉCOLE élan", "x--y", "ab1cd", "straße", "-a", "a-", "123",
    "\x1cnorth\x1f", "　south\xa0", "mIDDLE  eAST", "t-shirt x", "o'neil",
])
def test_title_case_matches_python(spark, value):
    out = C.normalise_text(raw(spark, {"category": value})).collect()[0].category
    assert out == value.strip().title()


def test_normalise_matches_python_on_random_text(spark):
    import random

    from salesengine.functions.text import normalise

    alphabet = list("abcXYZ") + ["é", "É", "ß", "ǆ", "ǅ", "ﬁ", "Ω", "ω", "5", "0", " ", " ", "-", "'", "&", ".",
                                  "\t", "\n", "\xa0", "　", "\x1c", "\x01"]
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(600)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(normalise(F.col("t"))).collect()]
    bad = [(t, g, t.strip().title()) for t, g in zip(texts, got) if g != t.strip().title()]
    assert not bad, bad[:5]


def test_parse_dates_random_against_rule(spark):
    import random
    import re

    from salesengine.functions.dates import parse_iso_date
    from salesengine.schema import MAX_DATE, MIN_DATE

    rnd = random.Random(5)

    def sample():
        y = rnd.choice([rnd.randint(1990, 2030), rnd.randint(1600, 1700), rnd.randint(2250, 2300), 0, 9999])
        m, d = rnd.randint(0, 13), rnd.randint(0, 32)
        fm, fd = rnd.choice(["{:02d}", "{}", "{:03d}"]), rnd.choice(["{:02d}", "{}"])
        s = f"{y:04d}-" + fm.format(m) + "-" + fd.format(d)
        return rnd.choice([s, s, s, " " + s, s + " ", s.replace("-", "/"), s[:-1], s + "T00:00"])

    def rule(s):
        if not re.fullmatch(r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", s):
            return None
        y, m, d = map(int, s.split("-"))
        try:
            v = dt.date(y, m, d)
        except ValueError:
            return None
        return v.isoformat() if MIN_DATE <= v.isoformat() <= MAX_DATE else None

    texts = [sample() for _ in range(800)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.date_format(parse_iso_date(F.col("t")), "yyyy-MM-dd")).collect()]
    bad = [(t, g, rule(t)) for t, g in zip(texts, got) if g != rule(t)]
    assert not bad, bad[:5]


def test_dedupe_and_status_brute_force(spark):
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        key = "HOT" if rnd.random() < 0.33 else rnd.choice([None, None] + [f"K{j}" for j in range(400)])
        rows.append({
            "transaction_id": key,
            "date": rnd.choice(["2023-01-05", "2023-02-30", "bad", "2023-7-9"]),
            "unit_price": rnd.choice([Decimal("1.00"), Decimal("0"), None]),
            "final_amount": Decimal(rnd.randint(-2, 900)),
        })
    order = list(range(3000))
    rnd.shuffle(order)
    df = raw(spark, *rows)
    df = df.withColumn("_o", F.element_at(F.array(*[F.lit(o) for o in order]), F.col("_o") + 1)).repartition(12)

    # Brute force: per key the row with the smallest order value, then T2, then T5.
    first = {}
    for r, o in zip(rows, order):
        k = r["transaction_id"]
        if k not in first or o < first[k][1]:
            first[k] = (r, o)

    def status(r):
        if r["date"] not in ("2023-01-05", "2023-7-9"):
            return C.BAD_DATE
        bad = (r["unit_price"] is not None and r["unit_price"] <= 0) or r["final_amount"] < 0
        return C.BAD_PRICE if bad else C.OK

    want = sorted((k or "", status(r), r["final_amount"]) for k, (r, _) in first.items())
    staged = C.clean_with_status(df, ORDER)
    got = sorted((r.transaction_id or "", r.dq_status, r.final_amount)
                 for r in staged.select("transaction_id", C.STATUS, "final_amount").collect())
    assert got == want
    counts = C.status_counts(staged).collect()[0]
    assert counts.raw_rows == 3000 and counts.duplicates == 3000 - len(first)


def test_a_larger_raw_view_has_more_shuffle_partitions(spark, monkeypatch):
    from salesengine.plans import pipeline
    from salesengine.session import INITIAL_PARTITIONS

    sf_dir = "/root/testdata/sf0.001"
    small, order = pipeline.star_raw(spark, sf_dir)
    assert small.sparkSession.conf.get(INITIAL_PARTITIONS, None) == spark.conf.get(INITIAL_PARTITIONS, None)
    spark.conf.set("spark.sql.files.openCostInBytes", "12345")
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    try:
        monkeypatch.setattr(pipeline, "input_bytes", lambda *_: 500 << 20)
        raw, _ = pipeline.star_raw(spark, sf_dir)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    conf = raw.sparkSession.conf
    assert int(conf.get(INITIAL_PARTITIONS)) == 125 and conf.get("spark.sql.files.openCostInBytes") == "12345"
    assert spark.conf.get(INITIAL_PARTITIONS, None) == before
    first = lambda df: sorted(map(str, C.clean_sales(df, order).collect()))
    assert first(raw) == first(small)
