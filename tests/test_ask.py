"""Questions answered from the rollups, stored results, and the fact table's layout."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from salesengine.operators.clean import clean_sales
from salesengine.operators.generate import generate_sales
from salesengine.operators.rollup import product_rollup, sales_rollup
from salesengine.operators.summaries import product_summary
from salesengine.plans import dashboard, questions, reports
from salesengine.plans.ask import ask, source_for
from salesengine.plans.pipeline import run
from salesengine.sources import results
from salesengine.sources.csv import write_csv
from salesengine.sources.results import cached_sql
from salesengine.sources.tables import open_tables, read_sales_table, sql, write_sales
from salesengine.sources.versions import current, vacuum


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("ask")
    write_csv(generate_sales(spark, 5000), str(base / "raw"))
    run(spark, str(base / "raw"), str(base / "out"), versioned=True)
    return str(base / "out")


def rows(df):
    return [tuple(r) for r in df.collect()]


POSITIVE = {"has_revenue": True}
#: Q1 to Q8 as questions: (report, arguments, table that answers).
ASKED = {
    "Q1": (reports.overview, dict(measures=["orders", "revenue", "mean_order_value", "return_rate_pct"]), "sales_rollup"),
    "Q2": (reports.monthly_trend, dict(measures=["revenue", "orders"], by=["year", "month"], where=POSITIVE, order=["year", "month"]), "sales_rollup"),
    "Q3": (reports.top_categories, dict(measures=["revenue", "orders", "mean_discount_pct"], by=["category"], where=POSITIVE, order=["-revenue", "category"], limit=5), "product_rollup"),
    "Q4": (reports.regional_performance, dict(measures=["revenue", "orders", "return_rate_pct"], by=["region"], order=["-revenue", "region"]), "sales_rollup"),
    "Q5": (reports.top_products_by_units, dict(measures=["units", "revenue"], by=["product_name", "category"], where=POSITIVE, order=["-units", "product_name", "category"], limit=10), "product_rollup"),
    "Q7": (reports.weekend_split, dict(measures=["orders", "revenue", "mean_order_value"], by=["day_type"], where=POSITIVE, order=["day_type"]), "sales_rollup"),
    "Q8": (reports.revenue_buckets, dict(measures=["rows", "revenue", "mean_order_value"], by=["revenue_bucket"], where=POSITIVE, order=["-mean_order_value", "revenue_bucket"]), "sales_rollup"),
    "N4": (lambda s: questions.monthly_in_quarter(s, 2023, 3), dict(measures=["revenue", "orders"], by=["year", "month"], where={**POSITIVE, "year": 2023, "quarter": 3}, order=["year", "month"]), "sales_rollup"),
    "D12": (dashboard.heat_long, dict(measures=["revenue_rounded"], by=["region", "category"], where=POSITIVE), "sales_rollup"),
}


@pytest.mark.parametrize("name", sorted(ASKED))
def test_questions_equal_the_reports_and_read_the_rollup(spark, out, name):
    report, asked, table = ASKED[name]
    tables = open_tables(spark, out)
    got = ask(tables, **asked)
    assert sorted(rows(got)) == sorted(rows(report(tables["sales"])))
    assert {f.split("/")[-2] for f in got.inputFiles()} == {table}
    assert sorted(rows(ask({"sales": tables["sales"]}, **asked))) == sorted(rows(got))  # the fact table alone gives the same


def test_payment_share_is_two_questions(spark, out):
    tables = open_tables(spark, out)
    total = ask(tables, ["rows"]).first()["rows"]
    assert [(m, n) for m, n, _ in rows(reports.payment_share(tables["sales"]))] == rows(ask(tables, ["rows"], by=["payment_method"], order=["-rows", "payment_method"]))
    assert total == tables["sales"].count()


def test_other_questions_read_the_fact_table(spark, out):
    tables = open_tables(spark, out)
    got = ask(tables, {"n": "rows", "sum": "revenue"}, by=["weekday"], where={"quantity": (2, 3), "payment_method": ["UPI", "Cash"]}, order=["weekday"])
    want = sql(spark, "SELECT weekday, count(*), CAST(sum(net_revenue) AS DOUBLE) FROM sales WHERE quantity BETWEEN 2 AND 3 AND payment_method IN ('UPI', 'Cash') GROUP BY 1 ORDER BY 1")
    assert rows(got) == rows(want) and all("/staged/" in f for f in got.inputFiles())
    assert source_for(tables, {"category", "sum_quantity"}) == "product_rollup"
    assert source_for(tables, {"category", "min_date"}) == "sales_rollup"
    for bad in (dict(measures=["rows"], by=["colour"]), dict(measures=["profit"])):
        with pytest.raises(ValueError):
            ask(tables, **bad)


def test_null_groups_and_filters(spark):
    raw = generate_sales(spark, 400).withColumn("region", F.when(F.col("region") != "North", F.col("region"))).withColumn("_o", F.lit(0))
    sales = clean_sales(raw, ["_o"])
    tables = {"sales": sales, "sales_rollup": sales_rollup(sales), "product_rollup": product_rollup(sales)}
    for where in ({}, {"region": None}, {"region": ["South"]}, {"region": ("East", None)}):
        both = [sorted(rows(ask(t, ["rows", "revenue"], by=["region"], where=where)), key=repr) for t in (tables, {"sales": sales})]
        assert both[0] == both[1]
    assert ask(tables, ["rows"], where={"region": None}).first()["rows"] == sales.where("region IS NULL").count() > 0


# --- stored results -------------------------------------------------------------
STATEMENT = "SELECT region, sum(net_revenue) AS revenue FROM sales WHERE category = :c GROUP BY region ORDER BY revenue DESC"


def stored(out):
    folder = os.path.join(out, results.RESULTS)
    return sum(len(os.listdir(os.path.join(folder, v))) for v in os.listdir(folder)) if os.path.isdir(folder) else 0


def test_second_call_reads_the_stored_result(spark, out):
    want = rows(sql(open_tables(spark, out)["sales"].sparkSession, STATEMENT, c="Sports"))
    before = stored(out)
    assert rows(cached_sql(spark, out, STATEMENT, c="Sports")) == want
    again = cached_sql(spark, out, f"  {STATEMENT};\n", c="Sports")
    assert rows(again) == want and all(f"/{results.RESULTS}/" in f for f in again.inputFiles())
    assert stored(out) == before + 1
    assert rows(cached_sql(spark, out, STATEMENT, c="Grocery")) != want and stored(out) == before + 2
    summary = cached_sql(spark, out, "SELECT * FROM product_summary")
    assert sorted(rows(summary)) == sorted(rows(product_summary(open_tables(spark, out)["sales"])))


def test_no_fact_file_is_needed_the_second_time(spark, tmp_out):
    base = os.path.join(tmp_out, "out")
    write_csv(generate_sales(spark, 300), os.path.join(tmp_out, "raw"))
    run(spark, os.path.join(tmp_out, "raw"), base, versioned=True)
    want = rows(cached_sql(spark, base, STATEMENT, c="Sports"))
    shutil.rmtree(os.path.join(current(spark, base), "staged"))
    assert rows(cached_sql(spark, base, STATEMENT, c="Sports")) == want


def test_a_new_version_has_results_of_its_own(spark, tmp_out):
    base = os.path.join(tmp_out, "out")
    counts = []
    for n in (200, 350):
        raw = os.path.join(tmp_out, f"raw{n}")
        write_csv(generate_sales(spark, n), raw)
        run(spark, raw, base, versioned=True)
        counts += [cached_sql(spark, base, "SELECT count(*) AS n FROM sales").first().n for _ in range(2)]
    assert counts == [200, 200, 350, 350] and stored(base) == 2
    vacuum(spark, base, keep=1, grace_hours=-1)
    assert stored(base) == 1


@pytest.mark.parametrize("text", [
    "SELECT count(*) AS n, current_date() AS d FROM sales", "SELECT rand() AS r FROM sales LIMIT 1", "SELECT 1 AS x FROM sales WHERE year < year(now()) LIMIT 1"])
def test_varying_statements_are_not_stored(spark, out, text):
    before = stored(out)
    assert cached_sql(spark, out, text).count() == 1 and stored(out) == before


def test_other_inputs_are_not_stored(spark, out, tmp_out):
    spark.range(3).write.parquet(os.path.join(tmp_out, "other"))
    before = stored(out)
    for text in (f"SELECT count(*) AS n FROM parquet.`{tmp_out}/other`", f"SELECT count(*) AS n FROM sales WHERE quantity IN (SELECT id FROM parquet.`{tmp_out}/other`)"):
        assert cached_sql(spark, out, text).first().n > 0
    assert stored(out) == before
    with_parts = "WITH a AS (SELECT * FROM sales WHERE quantity > (SELECT avg(quantity) FROM sales)) SELECT count(*) AS n FROM a"
    assert cached_sql(spark, out, with_parts).first().n > 0 and stored(out) == before + 1


def test_unversioned_tables_are_not_stored(spark, tmp_out):
    write_csv(generate_sales(spark, 100), os.path.join(tmp_out, "raw"))
    run(spark, os.path.join(tmp_out, "raw"), os.path.join(tmp_out, "out"))
    assert cached_sql(spark, os.path.join(tmp_out, "out"), "SELECT count(*) AS n FROM sales").first().n == 100
    assert stored(os.path.join(tmp_out, "out")) == 0


# --- layout ---------------------------------------------------------------------
def test_clustered_files_skip_row_groups(spark, tmp_out):
    """Rows that the scans of D8 and N3 read from the fact table, clustered and not."""
    sales = clean_sales(generate_sales(spark, 40_000).withColumn("_o", F.lit(0)), ["_o"]).where("year = 2023")
    small = {"parquet.block.size": "4096", "parquet.block.size.row.check.min": "10", "parquet.page.size.row.check.min": "10"}
    plain, sorted_ = os.path.join(tmp_out, "plain"), os.path.join(tmp_out, "sorted")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = {k: conf.get(k) for k in small}
    for k, v in small.items():
        conf.set(k, v)
    try:
        sales.repartition("year", "month").write.partitionBy("year", "month").parquet(plain)
        write_sales(sales, sorted_)
    finally:
        for k, v in old.items():
            conf.unset(k) if v is None else conf.set(k, v)

    def scanned(df):
        df.collect()
        plan, total = [df._jdf.queryExecution().executedPlan()], 0
        while plan:
            node = plan.pop()
            name = node.getClass().getSimpleName()
            if name == "AdaptiveSparkPlanExec":
                plan.append(node.executedPlan())
                continue
            if name.endswith("QueryStageExec"):
                plan.append(node.plan())
                continue
            if name == "FileSourceScanExec":
                total += node.metrics().apply("numOutputRows").value()
            children = node.children()
            plan += [children.apply(i) for i in range(children.size())]
        return total

    for report in (lambda s: dashboard.top_products(s, category="Sports"), lambda s: questions.top_products_in_category(s, "Sports")):
        a, b = (report(read_sales_table(spark, p)) for p in (plain, sorted_))
        assert rows(a) == rows(b)
        assert 0 < scanned(b) < 0.5 * scanned(a)


# --- dictionary -----------------------------------------------------------------
def test_pivot_plan_starts_no_job(spark):
    from salesengine.plans import registry

    sf = "/root/testdata/sf0.001"
    registry.star_rollup(spark, sf)
    spark.sparkContext.setJobGroup("plan", "pivot")
    try:
        df = registry.QUERIES["dash_heat_pivot"](spark, sf)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("plan")) == 0
        assert df.count() == 5 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("plan")) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_dictionary_of_a_run(spark, out):
    from salesengine.sources.domains import DOMAINS, read_domains, write_domains

    known = read_domains(spark, f"{current(spark, out)}/{DOMAINS}")
    sales = open_tables(spark, out)["sales"]
    for c, values in known.items():
        assert values == sorted(r[0] for r in sales.select(c).distinct().collect())
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        write_domains(open_tables(spark, out)["sales_rollup"], f"{out}/few.json")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
    assert read_domains(spark, f"{out}/few.json") == {} and read_domains(spark, f"{out}/none.json") is None
    write_domains(open_tables(spark, out)["sales_rollup"].where("1 = 0"), f"{out}/empty.json")
    assert read_domains(spark, f"{out}/empty.json")["category"] == []
