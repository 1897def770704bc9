"""The pipeline's stages against brute force, and on tables of edge cases."""

from __future__ import annotations

import os
import random

import pytest

import corpus_pipeline as P
from salesengine.llm import queries, simhash

from .test_operators import ROWS, prose

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1) for i, t in ROWS] + [(1000 + i, prose(120, i % 40), ["en", "de"][i % 2], "s", 2) for i in range(80)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_stages(spark, docs):
    assert [n for n, _ in P.STAGES] == ["language_id", "quality_rules", "simhash_near_dedup", "best_fit_packing"]
    now = docs
    for _, stage in P.STAGES[:3]:
        out = stage(spark, now, SF_SMALL)
        assert out.columns == docs.columns and out.count() <= now.count()
        assert out.exceptAll(now).count() == 0
        now = out
    first = {}
    for r in simhash.near_duplicates(P.quality_rules(spark, P.identify_language(spark, docs, SF_SMALL), SF_SMALL)).collect():
        first[r.component] = min(first.get(r.component, r.id), r.id)
    assert sorted(r.doc_id for r in now.collect()) == sorted(first.values())
    packed = P.pack(spark, now, SF_SMALL)
    assert {r.doc_id for r in packed.collect()} == set(first.values())


def test_texts_in_no_learned_language_go(spark):
    r = random.Random(8)
    stems = {"xx": ["tha", "ing", "wor", "ent"], "yy": ["sch", "über", "keit", "zu"]}
    known = [(i, " ".join("".join(r.choice(stems[g]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(5, 200))), g) for i, g in enumerate(["xx", "yy"] * 100)]
    other = ["Русский язык является одним из восточнославянских языков.", "汉语是世界上使用人数最多的语言之一。"]
    other += [" ".join("".join(r.choice("abcdfjklmpqvxyz") for _ in range(r.randint(3, 9))) for _ in range(60)) for _ in range(20)]
    table = spark.createDataFrame(known + [(1000 + i, t, None) for i, t in enumerate(other)], "doc_id long, text string, lang string")
    kept = {x.doc_id for x in P.identify_language(spark, table, SF_SMALL).collect()}
    assert kept == {i for i, _, _ in known}


def test_near_duplicates_with_null_and_repeated_ids(spark):
    texts = [prose(150, 300 + i) for i in range(9)]
    rows = [(None, t) for t in texts[:4]] + [(None, texts[0])] + [(7, t) for t in texts[4:7]] + [(3, texts[5]), (9, texts[6]), (None, texts[7]), (5, texts[7]), (7, texts[8]), (7, texts[8])]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted((repr(r.doc_id), r.text) for r in P.near_duplicates(spark, table, SF_SMALL).collect())
    want = [(None, t) for t in texts[:4]] + [(7, texts[4]), (3, texts[5]), (7, texts[6]), (5, texts[7]), (7, texts[8])]
    assert got == sorted((repr(i), t) for i, t in want)


def test_stages_on_an_empty_table(spark, docs):
    for _, stage in P.STAGES:
        assert stage(spark, docs.where("doc_id < -5"), SF_SMALL).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries_run(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0
    if name in queries.ORACLE_SQL:
        import duckdb

        con = duckdb.connect()
        for t in ("pages", "conversations", "documents", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
        assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))
