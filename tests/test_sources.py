"""S1-S5 and the end-to-end batch job over CSV files."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesengine.operators.clean import clean_sales
from salesengine.operators.generate import generate_sales
from salesengine.plans.pipeline import run
from salesengine.schema import RAW_COLUMNS, SALES
from salesengine.sources.csv import CSV_ORDER_COLUMNS, read_sales, write_csv
from salesengine.sources.tables import (
    SUMMARY_TABLES,
    read_sales_table,
    register_views,
    sql,
    write_sales,
)

HEADER = ",".join(RAW_COLUMNS)


def write_text(path, lines):
    with open(path, "w") as f:
        f.write("\n".join([HEADER] + lines) + "\n")
    return path


def test_read_sales_missing_tokens_and_bad_numbers(spark, tmp_out):
    p = write_text(os.path.join(tmp_out, "a.csv"), [
        "T1,2023-01-01,NA,NaN,null,1,10.5,0.1,10.5,,True",
        "T2,2023-01-02,Mat,Sports,North,abc,NA,NaN,,Cash,False",
        "T3,,n/a,Sports,North,2,1.00,0.2,1.6,UPI,",
    ])
    rows = {r.transaction_id: r for r in read_sales(spark, p).collect()}
    t1, t2, t3 = rows["T1"], rows["T2"], rows["T3"]
    assert (t1.product_name, t1.category, t1.region, t1.payment_method) == (None, None, None, None)
    assert t1.unit_price == Decimal("10.50") and t1.is_returned is True
    assert t2.quantity is None and t2.unit_price is None and t2.discount_pct is None
    assert t2.final_amount is None and t2.is_returned is False
    assert t3.date is None and t3.product_name is None and t3.is_returned is None


def test_first_wins_follows_file_order(spark, tmp_out):
    d = os.path.join(tmp_out, "in")
    os.makedirs(d)
    # The second file is larger (Spark schedules big files first); the first
    # named file must still win.
    write_text(os.path.join(d, "part-0.csv"), ["DUP,2023-01-01,A,Sports,North,1,1.00,0,1.00,UPI,False"])
    big = [f"X{i},2023-01-01,B,Sports,North,1,1.00,0,2.00,UPI,False" for i in range(3000)]
    write_text(os.path.join(d, "part-1.csv"), ["DUP,2023-01-01,B,Sports,North,1,1.00,0,2.00,UPI,False"] + big)
    out = clean_sales(read_sales(spark, d), CSV_ORDER_COLUMNS).filter("transaction_id = 'DUP'").collect()
    assert len(out) == 1 and out[0].product_name == "A"
    # Within one file the earlier line wins.
    write_text(os.path.join(d, "part-2.csv"), [
        "Z,2023-01-01,first,Sports,North,1,1.00,0,1.00,UPI,False",
        "Z,2023-01-01,second,Sports,North,1,1.00,0,1.00,UPI,False",
    ])
    z = clean_sales(read_sales(spark, d), CSV_ORDER_COLUMNS).filter("transaction_id = 'Z'").collect()
    assert [r.product_name for r in z] == ["first"]


def test_csv_round_trip(spark, tmp_out):
    g = generate_sales(spark, 500)
    p = os.path.join(tmp_out, "raw")
    write_csv(g, p)
    back = read_sales(spark, p, with_order=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, g.collect()))


def test_fact_table_partitioned_round_trip(spark, tmp_out):
    g = generate_sales(spark, 800)
    from pyspark.sql import functions as F

    sales = clean_sales(g.withColumn("_o", F.lit(0)), ["_o"])
    p = os.path.join(tmp_out, "sales")
    write_sales(sales, p)
    assert any(n.startswith("year=2023") for n in os.listdir(p))
    back = read_sales_table(spark, p)
    assert back.schema == SALES
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sales.collect()))


def test_run_end_to_end(spark, tmp_out):
    raw = os.path.join(tmp_out, "raw")
    write_csv(generate_sales(spark, 4000), raw)
    res = run(spark, raw, os.path.join(tmp_out, "out"))
    assert res.sales.count() == 4000
    assert set(res.summary_paths) == set(SUMMARY_TABLES)
    for p in res.summary_paths.values():
        assert spark.read.parquet(p).count() > 0
    q = res.quality.collect()[0]
    assert (q.raw_rows, q.duplicates, q.bad_dates, q.bad_prices, q.clean_rows) == (4000, 0, 0, 0, 4000)


def test_run_dirty_input_one_pass(spark, tmp_out):
    from salesengine.operators.clean import quality_counts

    d = os.path.join(tmp_out, "dirty")
    os.makedirs(d)
    write_text(os.path.join(d, "a.csv"), [
        "A,2023-01-01,P, sPORTS ,north,1,1.00,0.5,1.00,UPI,False",
        "A,2023-01-02,P,Sports,North,1,1.00,0.5,9.00,UPI,False",
        "B,not-a-date,P,Sports,North,1,1.00,0.5,1.00,UPI,False",
        "C,2023-01-03,P,Sports,North,1,0,0.5,1.00,UPI,False",
        "D,2023-01-04,P,Sports,North,1,1.00,1.5,600.00,Cash,True",
    ])
    res = run(spark, d, os.path.join(tmp_out, "out"))
    q = res.quality.collect()[0].asDict()
    assert q == quality_counts(read_sales(spark, d), CSV_ORDER_COLUMNS).collect()[0].asDict()
    assert q == {"raw_rows": 5, "duplicates": 1, "bad_dates": 1, "bad_prices": 1, "clean_rows": 2}
    got = sorted(map(tuple, res.sales.collect()))
    assert got == sorted(map(tuple, clean_sales(read_sales(spark, d), CSV_ORDER_COLUMNS).collect()))
    assert {r.final_amount for r in res.sales.collect()} == {Decimal("1.00"), Decimal("600.00")}


def test_sql_binds_parameters(spark, tmp_out):
    from pyspark.sql import functions as F

    sales = clean_sales(generate_sales(spark, 1000).withColumn("_o", F.lit(0)), ["_o"])
    register_views(spark, sales)
    got = sql(spark, "SELECT count(*) AS n FROM sales WHERE category = :c", c="Sports").collect()[0].n
    assert got == sales.filter("category = 'Sports'").count()
    # A quote in the value is data, not SQL.
    assert sql(spark, "SELECT count(*) AS n FROM sales WHERE category = :c", c="x' OR '1'='1").collect()[0].n == 0
    assert spark.table("regional_summary").count() == 5


def test_read_sales_rfc4180_quotes(spark, tmp_out):
    p = write_text(os.path.join(tmp_out, "q.csv"), [
        'T1,2023-01-01,"Mat, ""Pro"" 5kg",Sports,North,1,1.00,0,1.00,UPI,False',
    ])
    r = read_sales(spark, p).collect()[0]
    assert r.product_name == 'Mat, "Pro" 5kg' and r.category == "Sports"
    out = os.path.join(tmp_out, "rt")
    write_csv(read_sales(spark, p, with_order=False), out)
    assert read_sales(spark, out).collect()[0].product_name == 'Mat, "Pro" 5kg'


def test_run_writes_rollup_and_summaries_agree(spark, tmp_out):
    from salesengine.operators.summaries import monthly_category_summary, regional_summary

    raw = os.path.join(tmp_out, "raw")
    write_csv(generate_sales(spark, 3000), raw)
    res = run(spark, raw, os.path.join(tmp_out, "out"), quality=False)
    assert res.rollup.agg({"n_rows": "sum"}).collect()[0][0] == 3000
    for name, f in [("monthly_category_summary", monthly_category_summary), ("regional_summary", regional_summary)]:
        written = sorted(map(tuple, spark.read.parquet(res.summary_paths[name]).collect()))
        assert written == sorted(map(tuple, f(res.sales).collect()))


def test_input_bytes(spark, tmp_out):
    from salesengine.sources.scan import input_bytes

    p = write_text(os.path.join(tmp_out, "s.csv"), ["T1,2023-01-01,A,Sports,North,1,1.00,0,1.00,UPI,False"])
    assert input_bytes(spark, p) == os.path.getsize(p)
    assert input_bytes(spark, [p, p]) == 2 * os.path.getsize(p)


def test_open_tables_after_run(spark, tmp_out):
    from salesengine.sources.tables import open_tables

    raw = os.path.join(tmp_out, "raw")
    write_csv(generate_sales(spark, 2000), raw)
    out = os.path.join(tmp_out, "out")
    run(spark, raw, out, quality=False)
    t = open_tables(spark, out)
    assert set(t) == {"sales", "sales_rollup", "product_rollup", *SUMMARY_TABLES}
    n = sql(spark, "SELECT sum(n_rows) AS n FROM sales_rollup WHERE category = :c", c="Sports").collect()[0].n
    assert n == sql(spark, "SELECT count(*) AS n FROM sales WHERE category = :c", c="Sports").collect()[0].n
    assert spark.table("regional_summary").count() == 5


def test_cli_generate_and_run(spark, tmp_out, capsys):
    import json

    from salesengine.__main__ import main

    main(["--raw", os.path.join(tmp_out, "raw"), "--out", os.path.join(tmp_out, "out"), "--generate", "1500"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["quality"] == {"raw_rows": 1500, "duplicates": 0, "bad_dates": 0, "bad_prices": 0,
                              "clean_rows": 1500}
    assert out["summary"]["total_records"] == 1500
    assert out["summary"]["min_date"] >= "2023-01-01" and out["summary"]["max_date"] <= "2023-12-31"


def test_read_sales_all_tokens_in_typed_columns(spark, tmp_out):
    from salesengine.schema import MISSING_TOKENS

    lines = [f"T{i},2023-01-01,P,Sports,North,{t},{t},{t},{t},UPI,{t}" for i, t in enumerate(MISSING_TOKENS)
             if "," not in t]
    lines.append("P, 2023-01-01,P,Sports,North, 3 ,\t1.50 , 0.25 ,1.00,UPI, True ")
    rows = {r.transaction_id: r for r in read_sales(spark, write_text(os.path.join(tmp_out, "t.csv"), lines)).collect()}
    for i, t in enumerate(MISSING_TOKENS):
        r = rows[f"T{i}"]
        assert (r.quantity, r.unit_price, r.discount_pct, r.final_amount, r.is_returned) == (None,) * 5, t
    p = rows["P"]
    assert (p.quantity, p.unit_price, p.discount_pct, p.is_returned) == (3, Decimal("1.50"), Decimal("0.2500"), True)
    assert p.date == " 2023-01-01"  # text keeps its spaces; T2 rejects it later


HEADER = "transaction_id,date,product_name,category,region,quantity,unit_price,discount_pct,final_amount,payment_method,is_returned"


def _file(folder, text):
    path = os.path.join(folder, "in.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_columns_are_read_by_name(spark, tmp_out):
    p = _file(tmp_out, ",date," + HEADER.replace("date,", "") + "\n0,2023-01-01,T1,A,Sports,North,3.0,1.00,0,1.00,UPI,0.0\n")
    row = read_sales(spark, p).collect()[0]
    assert (row.transaction_id, row.date, row.quantity, row.is_returned) == ("T1", "2023-01-01", 3, False)


def test_absent_column_is_an_error(spark, tmp_out):
    p = _file(tmp_out, HEADER.replace(",region", "") + "\nT1,2023-01-01,A,Sports,1,1.00,0,1.00,UPI,False\n")
    with pytest.raises(ValueError, match="region"):
        read_sales(spark, p)


def test_checks_see_unrounded_numbers(spark, tmp_out):
    from salesengine.operators.clean import clean_sales
    from salesengine.sources.csv import CSV_ORDER_COLUMNS

    cells = ["1,1.00,150,500.004", "1,0.004,0.12345,5.00", "1,1.00,0,-0.004", "1,1.00,,0.004"]
    p = _file(tmp_out, HEADER + "\n" + "".join(f"T{i},2023-01-01,A,Sports,North,{c},UPI,1.0\n" for i, c in enumerate(cells)))
    got = {r.transaction_id: r for r in clean_sales(read_sales(spark, p), CSV_ORDER_COLUMNS).collect()}
    assert set(got) == {"T0", "T1", "T3"}
    assert (float(got["T0"].discount_pct), got["T0"].revenue_bucket, got["T3"].revenue_bucket) == (1.0, "Medium", "Low")


@pytest.mark.parametrize("rows", ["", "T1,31/12/2023,A,Sports,North,1,1.00,0,1.00,UPI,False\n"])
def test_run_without_a_clean_row(spark, tmp_out, rows):
    from salesengine.plans.pipeline import run
    from salesengine.sources.tables import read_staged

    res = run(spark, _file(tmp_out, HEADER + "\n" + rows), os.path.join(tmp_out, "out"))
    n = len(rows.splitlines())
    assert res.sales.count() == 0
    assert tuple(x or 0 for x in res.quality.collect()[0]) == (n, 0, n, 0, 0)
    kept = [r.dq_raw_date for r in read_staged(spark, os.path.join(tmp_out, "out", "staged")).collect()]
    assert kept == ["31/12/2023"] * n


def test_input_bytes_takes_globs(spark, tmp_out):
    from salesengine.sources.scan import input_bytes

    p = _file(tmp_out, HEADER + "\n")
    assert input_bytes(spark, os.path.join(tmp_out, "*.csv")) == os.path.getsize(p)
    with pytest.raises(FileNotFoundError):
        input_bytes(spark, os.path.join(tmp_out, "absent-*.csv"))


def test_compressed_csv_is_read_back(spark, tmp_path):
    from salesengine.schema import RAW_SALES
    from salesengine.sources.csv import read_sales, write_csv

    rows = [(f"t{i}", "2023-01-02", 'a "b", c', "c", "r", i, None, None, None, "p", True) for i in range(20)]
    df = spark.createDataFrame(rows, RAW_SALES).repartition(3)
    write_csv(df, str(tmp_path / "gz"), compression="gzip")
    write_csv(df, str(tmp_path / "plain"))
    assert len(list((tmp_path / "gz").glob("*.csv.gz"))) == len(list((tmp_path / "plain").glob("*.csv")))
    read = lambda at: sorted(map(str, read_sales(spark, str(tmp_path / at), with_order=False).collect()))
    assert read("gz") == read("plain")


def test_raw_files_of_star_tables_take_one_shuffle_after_the_parts(spark, monkeypatch):
    from salesengine.operators import clean as C
    from salesengine.plans import pipeline, registry

    sf_dir, plans, write = "/root/testdata/sf0.001", [], registry.write_csv
    monkeypatch.setattr(registry, "write_csv", lambda df, path, **more: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, path, **more)))
    registry.QUERIES["csv_clean_sales"](spark, sf_dir).collect()
    assert "rangepartitioning" not in plans[0] and "hashpartitioning(transaction_id" not in plans[0]
    assert plans[0].count("REPARTITION_BY_COL") == 1
    # copies stay together though Spark splits whatever it may
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.01"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        raw, order = pipeline.star_raw(spark, sf_dir, together=True)
        placed = registry.in_order(raw, order, together=True).withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id())
        assert placed.groupBy(C.KEY).agg(F.count_distinct("_part").alias("n")).where("n > 1").isEmpty()
        first = lambda df, by: sorted(map(str, C.dedupe_first(df, by).collect()))
        assert first(placed.drop("_part"), ["_pos"]) == first(*pipeline.star_raw(spark, sf_dir))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_shuffle_files_go_when_a_table_is_written(spark, tmp_out):
    import time

    from salesengine.session import RELEASE
    from salesengine.sources.csv import write_csv
    from salesengine.sources.tables import write_staged, write_table

    folders = [str(f) for f in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {n for f in folders for _, _, names in os.walk(f) for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    rows = spark.range(5000).select((F.col("id") % 700).alias("key"), F.lit("ok").alias("dq_status"), F.lit(2020).alias("year"), F.lit(1).alias("month"), F.lit("a").alias("category"), F.lit("b").alias("region"))
    for name, write in (("a", write_table), ("b", write_csv), ("c", write_staged)):
        before = shuffled()
        write(rows.repartition(3, "key"), os.path.join(tmp_out, name))
        until = time.time() + 20
        while shuffled() - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffled() - before, name
    assert spark.conf.get(RELEASE, None) in (None, "false")
