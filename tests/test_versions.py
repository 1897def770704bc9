"""Table sets replaced as one."""

from __future__ import annotations

import os

import pytest

from salesengine.operators.generate import generate_sales
from salesengine.plans import pipeline
from salesengine.plans.pipeline import run
from salesengine.session import work_dir
from salesengine.sources import versions
from salesengine.sources.csv import write_csv
from salesengine.sources.domains import DOMAINS, read_domains
from salesengine.sources.tables import SUMMARY_TABLES, open_tables


@pytest.fixture()
def raw(spark, tmp_out):
    paths = [os.path.join(tmp_out, f"raw{n}") for n in (300, 500)]
    for p, n in zip(paths, (300, 500)):
        write_csv(generate_sales(spark, n), p)
    return paths


@pytest.mark.parametrize("step", ["write_staged", "write_table", "write_summaries", "commit"])
def test_a_run_that_dies_leaves_the_old_set(spark, tmp_out, raw, monkeypatch, step):
    out = os.path.join(tmp_out, "out")
    run(spark, raw[0], out, versioned=True)
    before = {name: df.collect() for name, df in open_tables(spark, out).items()}
    assert len(before["sales"]) == 300

    with monkeypatch.context() as m:
        real, calls = getattr(pipeline, step), []

        def dies(*args, **kw):
            calls.append(1)
            if step != "write_table" or len(calls) == 2:  # with one rollup written, the other not
                raise RuntimeError("killed")
            return real(*args, **kw)

        m.setattr(pipeline, step, dies)
        with pytest.raises(RuntimeError, match="killed"):
            run(spark, raw[1], out, versioned=True)
    assert {name: df.collect() for name, df in open_tables(spark, out).items()} == before

    run(spark, raw[1], out, versioned=True)
    after = open_tables(spark, out)
    assert after["sales"].count() == 500 == after["sales_rollup"].agg({"n_rows": "sum"}).first()[0]
    assert [n for n, _ in versions.commits(spark, out)] == [1, 2]


def test_readers_of_an_old_set_go_on(spark, tmp_out, raw):
    out = os.path.join(tmp_out, "out")
    run(spark, raw[0], out, versioned=True)
    old = open_tables(spark, out)
    run(spark, raw[1], out, versioned=True)
    assert old["sales"].count() == 300 and all(old[t].count() > 0 for t in SUMMARY_TABLES)


def test_vacuum_keeps_the_last_sets_and_running_ones(spark, tmp_out, raw):
    out = os.path.join(tmp_out, "out")
    folders = [run(spark, raw[0], out, versioned=True).folder for _ in range(3)]
    assert versions.vacuum(spark, out, keep=1) == []  # within the grace
    begun = versions.new_version(spark, out)
    os.makedirs(begun)
    assert sorted(versions.vacuum(spark, out, keep=2, grace_hours=-1)) == sorted([folders[0], begun])
    assert versions.current(spark, out) == folders[2] and [f for _, f in versions.commits(spark, out)] == folders[1:]
    assert open_tables(spark, out)["sales"].count() == 300
    with pytest.raises(ValueError):
        versions.vacuum(spark, out, keep=0)


def test_commits_of_one_number_are_both_whole(spark, tmp_out):
    a, b = versions.new_version(spark, tmp_out), versions.new_version(spark, tmp_out)
    versions.commit(spark, tmp_out, a)
    os.rename(*[os.path.join(tmp_out, versions.COMMITS, f"{n:012d}-{a.rpartition('/')[2]}") for n in (1, 7)])
    open(os.path.join(tmp_out, versions.COMMITS, f"{7:012d}-{b.rpartition('/')[2]}"), "w").close()
    assert versions.current(spark, tmp_out) == max(a, b)
    assert versions.version_of(spark, tmp_out)[0] == 7


def test_unversioned_runs_are_read_as_before(spark, tmp_out, raw):
    out = os.path.join(tmp_out, "out")
    run(spark, raw[0], out)
    assert versions.version_of(spark, out) == (0, out) and open_tables(spark, out)["sales"].count() == 300


def test_star_set_cleans_the_raw_view_once(spark, monkeypatch):
    from salesengine.plans import pipeline, registry

    sf_dir, cleaned, clean = "/root/testdata/sf0.001", [], pipeline.clean_with_status
    want = sorted(map(str, registry.QUERIES["product_summary"](spark, sf_dir).collect()))
    monkeypatch.setattr(pipeline, "_written", {})
    monkeypatch.setattr(pipeline, "clean_with_status", lambda *a: (cleaned.append(1), clean(*a))[1])
    got = registry.QUERIES["versioned_product_summary"](spark, sf_dir)
    assert sorted(map(str, got.collect())) == want and len(cleaned) == 1
    assert not [n for n in versions._names(spark, f"{work_dir(spark)}/salesengine") if n.startswith("first-")]
    base = pipeline.star_set(spark, sf_dir)
    tables = open_tables(spark, base)
    assert tables["sales"].count() == pipeline.star_sales(spark, sf_dir).count() and len(cleaned) == 1
    for name, rows in (("sales_rollup", pipeline.star_rollup(spark, sf_dir)), ("product_rollup", pipeline.star_products(spark, sf_dir))):
        assert tables[name].schema == rows.schema and sorted(map(str, tables[name].collect())) == sorted(map(str, rows.collect()))
    assert len(versions.commits(spark, base)) == 1 and read_domains(spark, f"{versions.current(spark, base)}/{DOMAINS}")
