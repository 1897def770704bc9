"""Every registered query equals its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck, norm  # noqa: E402

from salesengine.plans.registry import QUERIES  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    ok, n, _, msg = compare(spark, con, key, SF_SMALL)
    assert ok, msg
    assert n > 0


#: Reports whose statement ends with an ORDER BY of its own (and a LIMIT, maybe).
ORDERED = sorted(k for k in QUERIES if re.search(r"ORDER BY [^()]*(\([^()]*\)[^()]*)*\Z", E.oracle_sql()[k]))


def test_ordered_reports_are_found():
    assert len(ORDERED) >= 20


@pytest.mark.parametrize("key", ORDERED)
def test_rows_come_in_the_order_of_the_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    found = con.execute(E.oracle_sql()[key])
    names = [d[0] for d in found.description]
    want = [tuple(map(norm, r)) for r in found.fetchall()]
    assert [tuple(norm(r[c]) for c in names) for r in df.collect()] == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "total_revenue", "total_orders", "return_rate_pct"]
    assert df.count() == 5
