"""Benchmark: the batch job, then every report over the written fact table.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line. ``etl`` is raw view -> cleaning -> one write
partitioned by data-quality status and year/month (the ``ok`` part is the
fact table); ``rollup`` / ``product_rollup`` write the two rollups; ``summaries`` writes the
three summary tables; ``quality`` reads the data-quality counters back from
the staged write; every other entry is one report, collected from a rollup (ad-hoc SQL:
the fact table). ``value`` is the sum of all entries.

JVM warm-up: the same suite first runs once, untimed, on the sf0.01 tables
(``$BENCH_WARMUP_DIR``; empty to skip). Nothing carries over between the two
passes (other input, fresh output folders, no caching), so the timed pass
measures steady-state throughput rather than the JIT compiling Spark's code
paths for the first time, which a long job on a cluster pays only once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesengine.operators.clean import clean_with_status, status_counts  # noqa: E402
from salesengine.operators.rollup import product_rollup, sales_rollup  # noqa: E402
from salesengine.plans.pipeline import star_raw  # noqa: E402
from salesengine.plans.registry import QUERIES  # noqa: E402
from salesengine.session import local_session, new_table_path  # noqa: E402
from salesengine.sources.csv import CSV_ORDER_COLUMNS, read_sales, write_csv  # noqa: E402
from salesengine.sources.tables import read_sales_table, write_staged, write_summaries, write_table  # noqa: E402

# Keys that write before they read are timed as steps of the job, not as reports.
BUILT = ("quality_counts", "fact_table", "csv_clean_sales", "status_counts", "cached_adhoc_sql")
SALES_KEYS = [k for k in QUERIES if not k.startswith(("clean_", "csv_", "written_", "versioned_")) and k not in BUILT]


def suite(spark, sf_dir: str) -> dict[str, float]:
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    raw, order = star_raw(spark, sf_dir)
    staged = new_table_path(spark, "bench-staged")
    path = timed("etl", lambda: write_staged(clean_with_status(raw, order), staged))
    sales = read_sales_table(spark, path)
    rollup_path = new_table_path(spark, "bench-rollup")
    products_path = new_table_path(spark, "bench-products")
    timed("rollup", lambda: write_table(sales_rollup(sales), rollup_path))
    timed("product_rollup", lambda: write_table(product_rollup(sales), products_path))
    rollup, products = spark.read.parquet(rollup_path), spark.read.parquet(products_path)
    timed("summaries", lambda: write_summaries(sales, new_table_path(spark, "bench-summaries"),
                                               rollup=rollup, products=products))
    timed("quality", lambda: status_counts(spark.read.parquet(staged)).collect())

    # The job's real input: CSV files, read by name, cleaned and written.
    csv = new_table_path(spark, "bench-csv")
    write_csv(raw.drop(*order), csv)
    timed("csv_etl", lambda: write_staged(clean_with_status(read_sales(spark, csv), CSV_ORDER_COLUMNS), new_table_path(spark, "bench-csv-staged")))

    # The registered report callables read the tables written above.
    import salesengine.plans.pipeline as P

    P._written[P._key(spark, sf_dir, "staged")] = staged
    P._written[P._key(spark, sf_dir, "sales")] = path
    P._written[P._key(spark, sf_dir, "rollup")] = rollup_path
    P._written[P._key(spark, sf_dir, "products")] = products_path
    for k in SALES_KEYS:
        timed(k, lambda k=k: QUERIES[k](spark, sf_dir).collect())
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # per-stage times for diagnosis
        conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = local_session(cpus, app="salesengine-bench", shuffle_partitions=int(cpus) * 2, **conf)
    if warm_dir and warm_dir != sf_dir and os.path.isdir(warm_dir):
        suite(spark, warm_dir)
    times = suite(spark, sf_dir)

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
