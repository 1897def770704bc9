"""bench.py's suite runs end to end and times every report."""

from __future__ import annotations

import bench


def test_bench_suite_times_everything(spark):
    times = bench.suite(spark, "/root/testdata/sf0.001")
    assert {"etl", "rollup", "product_rollup", "summaries", "quality"} <= set(times)
    assert set(bench.SALES_KEYS) <= set(times)
    assert all(isinstance(v, float) and v >= 0 for v in times.values())
