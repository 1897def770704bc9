"""CSV records across lines and splits, and what reading loses."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesengine.plans.pipeline import run
from salesengine.schema import RAW_COLUMNS
from salesengine.sources import records
from salesengine.sources.csv import (
    CSV_ORDER_COLUMNS,
    LOST,
    PROBLEM,
    RECORD,
    accepted,
    checked_sales,
    loss_counts,
    read_sales,
)

HEADER = ",".join(RAW_COLUMNS)
SPLITS = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "8"}


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k, None) for k in SPLITS}
    for k, v in SPLITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def cell(r):
    k = r.random()
    if k < 0.3:
        return '"' + "".join(r.choice(["a", '""', "\n", "\r\n", ",", "é", " "]) for _ in range(r.randint(0, 30))) + '"'
    if k < 0.4:
        return 'un"quoted" x'
    if k < 0.45:
        return '"a"b'
    return "".join(r.choice("abc ") for _ in range(r.randint(1, 12)))


def files(folder, seed, n=300):
    r = random.Random(seed)
    os.makedirs(folder)
    for f in range(3):
        rows = [HEADER + "\n"]
        for i in range(n):
            rows.append(f"T{f}-{i},2023-01-0{i % 9 + 1},{cell(r)},{cell(r)},{cell(r)},1,2.5,0,{r.choice(['1', 'x'])},{cell(r)},True" + r.choice(["\n", "\n", "\r\n"]))
            if i == 100:
                rows.append("\n")
            if i == 200 and f == 1:  # a record longer than several splits
                rows.append(f'T{f}-big,2023-01-01,"' + "line\n" * 2000 + '",c,r,1,1,0,1,p,True\n')
        write(f"{folder}/f{f}.csv", "".join(rows))
    return folder


@pytest.mark.parametrize("seed, piece", [(1, None), (2, 300), (3, 1)])
def test_same_rows_as_one_task_a_file(spark, tmp_out, small_splits, monkeypatch, seed, piece):
    if piece:
        monkeypatch.setattr(records, "PIECE", piece)
    path = files(os.path.join(tmp_out, "raw"), seed)
    assert spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 20
    want = read_sales(spark, path, with_order=False, multi_line=True)
    got = read_sales(spark, path, with_order=False, quoted_breaks=True)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    ordered = [r.transaction_id for r in read_sales(spark, path, quoted_breaks=True).orderBy(*CSV_ORDER_COLUMNS).collect()]
    assert ordered[:300] == [f"T0-{i}" for i in range(300)] and ordered[501] == "T1-big"


def test_steps_and_states_against_a_scanner(spark):
    r = random.Random(4)
    lines = ["".join(r.choice(['"', '"', ",", "a", "\r"]) for _ in range(r.randint(0, 9))) for _ in range(3000)]

    def ends(line, inside):
        fresh, i = not inside, 0  # fresh: at the start of a field
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    inside = False
            elif c == ",":
                fresh = True
                i += 1
                continue
            elif c == '"' and fresh:
                inside = True
            fresh = False
            i += 1
        return inside

    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = dict(df.select("i", records.step_of(F.col("line"))).collect())
    table = {records.KEEP: (0, 1), records.SWAP: (1, 0), records.OUTSIDE: (0, 0), records.INSIDE: (1, 1)}
    assert [table[got[i]] for i in range(len(lines))] == [(ends(x, False), ends(x, True)) for x in lines]
    steps = np.array([got[i] for i in range(len(lines))])
    for start in (0, 1):
        state, want = start, [start]
        for s in steps:
            state = table[int(s)][state]
            want.append(int(state))
        assert records.states(steps, start).tolist() == want


BROKEN = [
    "A,2023-01-01,P,Sports,North,1,1.00,0,1.00,UPI,False",
    "B,2023-01-01,P,Sports,North,1,1.00,0,1.00,UPI,False,more",
    "C,2023-01-01,P,Sports,North,two,n/k,0,1.00,UPI,NA",
    'D,2023-01-01,"P, ""Q""",Sports,North,1,1.00,0,1.00',
    'E,2023-01-01,"P,Q",Sports,North,1,1.00,0,1.00,UPI,False,"x,y",z',
]


@pytest.mark.parametrize("quoted_breaks", [False, True])
def test_problems_and_losses(spark, tmp_out, quoted_breaks):
    path = write(os.path.join(tmp_out, "a.csv"), "\n".join([HEADER, *BROKEN, 'F,2023-01-01,"open,Sports']) + "\n")
    got = checked_sales(spark, path, quoted_breaks=quoted_breaks)
    rows = {r.transaction_id if r[PROBLEM] != "open_quote" else "F": r for r in got.collect()}
    assert {k: r[PROBLEM] for k, r in rows.items()} == {"A": None, "B": "too_many_fields", "C": None, "D": "too_few_fields", "E": "too_many_fields", "F": "open_quote"}
    assert rows["C"][LOST] == ["quantity", "unit_price"] and rows["A"][LOST] == []
    assert rows["B"][RECORD] == BROKEN[1] and rows["D"].product_name == 'P, "Q"' and rows["D"].payment_method is None
    assert sorted(r.transaction_id for r in accepted(got).collect()) == ["A", "C", "D"]
    counts = {(r.what, r.column_name): r.n for r in loss_counts(got).collect()}
    assert counts["records", None] == 6 == counts["sound", None] + sum(counts[p, None] for p in ("too_many_fields", "too_few_fields", "open_quote"))
    assert counts["lost_value", "quantity"] == counts["lost_value", "unit_price"] == 1 and counts["lost_value", "final_amount"] == 0


def test_open_record_reaches_to_the_end_of_its_file_only(spark, tmp_out, small_splits):
    folder = os.path.join(tmp_out, "raw")
    os.makedirs(folder)
    rows = "".join(f"T{i},2023-01-01,P,Sports,North,1,1.00,0,1.00,UPI,False\n" for i in range(200))
    write(f"{folder}/a.csv", f'{HEADER}\n{rows}X,2023-01-01,"never closed\n{rows}')
    write(f"{folder}/b.csv", f"{HEADER}\n{rows.replace('T', 'U')}")
    got = checked_sales(spark, folder, quoted_breaks=True)
    assert accepted(got).count() == 400 and got.where(F.col(PROBLEM) == "open_quote").count() == 1
    assert {r.transaction_id[0] for r in read_sales(spark, folder, quoted_breaks=True).collect()} == {"T", "U"}


def test_headers_are_compared(spark, tmp_out):
    folder = os.path.join(tmp_out, "raw")
    os.makedirs(folder)
    row = "T,2023-01-01,P,Sports,North,1,1.00,0,1.00,UPI,False\n"
    write(f"{folder}/a.csv", f"{HEADER}\n{row}")
    write(f"{folder}/b.csv", ",".join(f'"{c}"' for c in RAW_COLUMNS) + "\r\n" + row)
    assert read_sales(spark, folder, quoted_breaks=True).count() == 2
    write(f"{folder}/c.csv", HEADER.replace("region", "area") + "\n" + row)
    with pytest.raises(Exception, match="header differs"):
        read_sales(spark, folder, quoted_breaks=True).collect()
    with pytest.raises(ValueError, match="no column"):
        read_sales(spark, write(os.path.join(tmp_out, "x.csv"), "a,b\n1,2\n"), quoted_breaks=True)


def test_no_rows(spark, tmp_out):
    path = write(os.path.join(tmp_out, "a.csv"), HEADER + "\n")
    assert read_sales(spark, path, quoted_breaks=True).count() == 0
    assert {r.n for r in loss_counts(checked_sales(spark, path)).collect()} == {0}


def test_run_with_quarantine(spark, tmp_out):
    path = write(os.path.join(tmp_out, "a.csv"), "\n".join([HEADER, *BROKEN, BROKEN[0], 'G,2023-01-01,"P\nQ",Sports,North,1,1.00,0,1.00,UPI,False']) + "\n")
    out = os.path.join(tmp_out, "out")
    res = run(spark, path, out, quoted_breaks=True, quarantine=True)
    assert {r.transaction_id: r.product_name for r in res.sales.collect()} == {"A": "P", "C": "P", "D": 'P, "Q"', "G": "P\nQ"}
    counts = {(r.what, r.column_name): r.n for r in res.losses.collect()}
    assert counts == {(r.what, r.column_name): r.n for r in loss_counts(checked_sales(spark, path, quoted_breaks=True)).collect()}
    assert counts["records", None] == 7 and counts["sound", None] == 4
    kept = spark.read.parquet(f"{out}/quarantine").collect()
    assert sorted((r.transaction_id, r[PROBLEM] or ",".join(r[LOST])) for r in kept) == [("B", "too_many_fields"), ("C", "quantity,unit_price"), ("D", "too_few_fields"), ("E", "too_many_fields")]


def test_each_pattern_of_a_step_is_matched_once(spark):
    lines = spark.createDataFrame([('a,"b',), ('"a","b"',), ("a",)], "line string").select(records.step_of(F.col("line")).alias("step"))
    assert lines._jdf.queryExecution().analyzed().toString().count("RLIKE") == 2
    assert [r[0] for r in lines.collect()] == [records.SWAP, records.OUTSIDE, records.KEEP]


def test_raw_files_keep_the_order_of_copies_without_range_partitions(spark):
    from salesengine.operators import clean as C
    from salesengine.plans.pipeline import star_raw
    from salesengine.plans.registry import in_order

    raw, order = star_raw(spark, "/root/testdata/sf0.001")
    rows = in_order(raw, order)
    assert "rangepartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    placed = rows.withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id())
    assert placed.groupBy(C.KEY).agg(F.count_distinct("_part").alias("n")).where("n > 1").isEmpty()
    first = lambda df, by: sorted(map(str, C.dedupe_first(df, by).collect()))
    assert first(placed.drop("_part"), ["_pos"]) == first(raw, order)
