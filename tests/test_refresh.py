"""Refresh of a set by batches against a run over all files, and T1 by suspected keys."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from salesengine.operators import clean
from salesengine.operators.generate import generate_sales
from salesengine.plans.pipeline import run
from salesengine.plans.refresh import refresh
from salesengine.schema import RAW_COLUMNS
from salesengine.sources import versions
from salesengine.sources.domains import DOMAINS, read_domains
from salesengine.sources.tables import SUMMARY_TABLES, open_tables


def batch(path, seed, n):
    r = random.Random(seed)
    lines = [",".join(RAW_COLUMNS)]
    for _ in range(n):
        key = r.choice(["", f"T{r.randint(0, 60)}", f"T{r.randint(0, 10_000)}"])
        date = r.choice([f"20{r.randint(21, 23)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}"] * 6 + ["bad", ""])
        lines.append(",".join([key, date, r.choice("PQR"), r.choice([" sports", "TOYS", ""]), r.choice(["north", ""]), r.choice(["1", "2", ""]), r.choice(["1.50", "0", "x"]),
                               r.choice(["0.1", "2", ""]), r.choice(["10.25", "700", "-1", ""]), "UPI", r.choice(["True", "False", ""])]))
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def values(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


@pytest.mark.parametrize("seed, sizes", [(1, [200, 150, 90]), (2, [0, 120, 0]), (3, [60, 1])])
def test_batches_equal_a_full_run(spark, tmp_out, seed, sizes):
    paths = [batch(os.path.join(tmp_out, f"raw/b{k}.csv"), 10 * seed + k, n) for k, n in enumerate(sizes)]
    paths.append(batch(os.path.join(tmp_out, f"raw/b{len(sizes)}.csv"), 10 * seed, sizes[0]))  # the first batch once more
    part = os.path.join(tmp_out, "parts")
    res = run(spark, paths[0], part, versioned=True)
    for k, p in enumerate(paths[1:], 1):
        whole = run(spark, paths[: k + 1], os.path.join(tmp_out, f"whole{k}"), versioned=True)
        res = refresh(spark, part, p)
        mine, full = open_tables(spark, part), open_tables(spark, os.path.join(tmp_out, f"whole{k}"))
        assert set(mine) == {"sales", "sales_rollup", "product_rollup", *SUMMARY_TABLES}
        for name in mine:
            assert mine[name].schema == full[name].schema and values(mine[name]) == values(full[name]), name
        assert tuple(x or 0 for x in res.quality.first()) == tuple(x or 0 for x in whole.quality.first())
        assert values(res.sales) == values(whole.sales)
        assert read_domains(spark, f"{res.folder}/{DOMAINS}") == read_domains(spark, f"{whole.folder}/{DOMAINS}")
    assert [n for n, _ in versions.commits(spark, part)] == list(range(1, len(paths) + 1))
    before = values(open_tables(spark, part)["sales"])
    assert versions.vacuum(spark, part, keep=1, grace_hours=-1) == []  # all are parts of the current set
    assert values(open_tables(spark, part)["sales"]) == before


def test_a_refresh_that_dies_changes_nothing(spark, tmp_out, monkeypatch):
    from salesengine.plans import refresh as module

    out = os.path.join(tmp_out, "out")
    run(spark, batch(os.path.join(tmp_out, "a.csv"), 1, 50), out, versioned=True)
    before = values(open_tables(spark, out)["sales_rollup"])
    monkeypatch.setattr(module, "write_json", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh(spark, out, batch(os.path.join(tmp_out, "b.csv"), 2, 50))
    assert values(open_tables(spark, out)["sales_rollup"]) == before and len(versions.commits(spark, out)) == 1


def test_only_versioned_sets_are_refreshed(spark, tmp_out):
    with pytest.raises(ValueError, match="no committed set"):
        refresh(spark, os.path.join(tmp_out, "out"), batch(os.path.join(tmp_out, "a.csv"), 1, 5))


@pytest.mark.parametrize("limit", [clean.SUSPECT_LIMIT, 3])
def test_suspected_keys_give_the_same_rows(spark, tmp_out, limit):
    raw = generate_sales(spark, 3000).withColumn("_o", F.monotonically_increasing_id())
    hot = raw.withColumn("transaction_id", F.when(F.col("_o") % 3 == 0, "HOT").when(F.col("_o") % 50 != 1, F.col("transaction_id")))
    table = raw.unionByName(raw.where("quantity = 2").withColumn("_o", F.col("_o") + 1)).unionByName(hot)
    table.write.parquet(os.path.join(tmp_out, "raw"))
    table = spark.read.parquet(os.path.join(tmp_out, "raw"))
    clean.suspected_keys(table).write.parquet(os.path.join(tmp_out, "keys"))
    got = clean.dedupe_suspects(table, ["_o"], spark.read.parquet(os.path.join(tmp_out, "keys")), limit)
    assert got.columns == clean.dedupe_first(table, ["_o"]).columns
    assert values(got) == values(clean.dedupe_first(table, ["_o"]))


def test_unique_rows_are_not_shuffled(spark, tmp_out):
    raw = generate_sales(spark, 2000).withColumn("_o", F.monotonically_increasing_id())
    raw.unionByName(raw.where("transaction_id like '%77'")).write.parquet(os.path.join(tmp_out, "raw"))
    table = spark.read.parquet(os.path.join(tmp_out, "raw"))
    clean.suspected_keys(table).write.parquet(os.path.join(tmp_out, "keys"))

    def shuffled(df):
        df.collect()
        todo, total = [df._jdf.queryExecution().executedPlan()], 0
        while todo:
            node = todo.pop()
            name = node.getClass().getSimpleName()
            if name == "AdaptiveSparkPlanExec":
                todo.append(node.executedPlan())
            elif name.endswith("QueryStageExec"):
                todo.append(node.plan())
            else:
                if name == "ShuffleExchangeExec":
                    total += node.metrics().apply("shuffleRecordsWritten").value()
                children = node.children()
                todo += [children.apply(i) for i in range(children.size())]
        return total

    few = shuffled(clean.dedupe_suspects(table, ["_o"], spark.read.parquet(os.path.join(tmp_out, "keys"))))
    assert few < 0.1 * shuffled(clean.dedupe_first(table, ["_o"]))


def test_a_batch_is_not_shuffled_to_months(spark, tmp_out):
    base = os.path.join(tmp_out, "set")
    run(spark, batch(os.path.join(tmp_out, "raw/a.csv"), 1, 40), base, versioned=True)
    res = refresh(spark, base, batch(os.path.join(tmp_out, "raw/b.csv"), 2, 40))
    assert not [n for n in os.listdir(f"{res.folder}/batch") if "=" in n]
    assert [n for n in os.listdir(f"{res.folder}/staged") if "=" in n]


def test_only_the_known_ids_are_shuffled_to_tell_late_rows(spark, tmp_out):
    from salesengine.plans import refresh as module
    from salesengine.sources.csv import CSV_ORDER_COLUMNS, read_sales
    from salesengine.sources.tables import read_staged

    base = os.path.join(tmp_out, "set")
    res = run(spark, batch(os.path.join(tmp_out, "raw/a.csv"), 1, 300), base, versioned=True)
    path = batch(os.path.join(tmp_out, "raw/b.csv"), 2, 300)
    cleaned = clean.clean_with_status(read_sales(spark, path), CSV_ORDER_COLUMNS)
    known = read_staged(spark, f"{res.folder}/staged")
    marked = module.with_late(cleaned, known)
    assert marked._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # T1's and that of the known ids
    ids = {r[0] for r in known.select(clean.KEY).collect()}
    assert None in ids
    want = sorted((str(r[clean.KEY] if r[clean.KEY] not in ids else None), r[clean.COPIES], r[clean.KEY] in ids) for r in cleaned.collect())
    assert sorted((str(r[clean.KEY]), r[clean.COPIES], r[module.IS_LATE]) for r in marked.collect()) == want
    again = refresh(spark, base, path)
    written = spark.read.parquet(f"{again.folder}/batch")
    late = written.where(module.IS_LATE)
    assert late.count() and all(late.where(F.col(c).isNotNull()).isEmpty() for c in written.columns if c not in (clean.COPIES, module.IS_LATE))
    fresh = written.where(~F.col(module.IS_LATE)).drop(module.IS_LATE)
    assert values(fresh) == values(read_staged(spark, f"{again.folder}/staged"))
