"""Names, types and labels that the stages must take, and the choices of packing."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from salesengine.llm import langid, packing, quality, simhash, template

from .test_operators import prose


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, prose(150, i % 20), ["en", "de"][i % 2], float(i), {"k": str(i)}, [i]) for i in range(40)] + [(99, None, "en", 0.0, None, None), (98, "123 456", "de", 0.0, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, `a.b` double, __fp map<string,string>, place array<long>")
    return table.withColumn("row", F.lit("x")).withColumn("c0", F.lit(1)).withColumn("lang_pred", F.lit(2)).withColumn("quality", F.lit(3))


def test_near_duplicates_take_any_names_and_types(odd):
    got = simhash.first_of_each(odd)
    assert got.dtypes == odd.dtypes
    rows = {r.doc_id: r for r in got.collect()}
    # the two texts without a word are one component
    assert sorted(rows) == [*range(20), 98] or sorted(rows) == [*range(20), 98, 99]
    assert all(rows[i]["a.b"] == float(i) and rows[i]["__fp"] == {"k": str(i)} and rows[i]["place"] == [i] for i in range(20))


def test_stages_take_columns_named_like_results(spark, odd):
    kept = P.identify_language(spark, odd, "")
    assert kept.dtypes == odd.dtypes and {r.doc_id for r in kept.collect()} <= set(range(40))
    assert P.quality_rules(spark, odd, "").dtypes == odd.dtypes


def test_clashing_names_are_errors(spark, odd):
    with pytest.raises(ValueError, match="lang_pred"):
        langid.predict(odd, langid.fit(odd))
    with pytest.raises(ValueError, match="quality"):
        quality.score(odd, quality.fit(odd))
    with pytest.raises(ValueError, match="text"):
        template.extract(spark.createDataFrame([("u", "h", "t")], "url string, html string, TEXT string"))


def test_a_corpus_without_labels_is_kept(spark):
    rows = [(i, prose(80, i)) for i in range(30)] + [(30, None), (31, ""), (32, "12 !?")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert langid.fit(table) is None
    assert {r.doc_id for r in P.identify_language(spark, table, "").collect()} == set(range(30))
    assert {(r.lang_pred, r.lang_score) for r in langid.predict(table, None).collect()} == {("und", 0.0)}


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    table = spark.createDataFrame([(i, f"text {i}", f"l{i}") for i in range(4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 3 languages"):
        langid.fit(table)


# --- packing ------------------------------------------------------------------------
def total_work(capacities):
    return sum(packing.work(c) for c in capacities)


def best_work(lengths, capacities):
    """Least work over all partitions of a few lengths."""
    best = np.inf

    def place(i, bins):
        nonlocal best
        if i == len(lengths):
            best = min(best, total_work(min(c for c in capacities if c >= sum(b)) for b in bins))
            return
        for b in bins:
            if sum(b) + lengths[i] <= capacities[-1]:
                b.append(lengths[i])
                place(i + 1, bins)
                b.pop()
        place(i + 1, [*bins, [lengths[i]]])

    place(0, [])
    return best


def test_packing_is_near_the_optimum():
    r = random.Random(6)
    ratios = []
    for n, _ in itertools.product(range(1, 8), range(30)):
        lengths = sorted((r.choice([r.randint(1, 600), r.randint(1, 8192), r.choice([512, 1024, 4096])]) for _ in range(n)), reverse=True)
        of, capacities = packing.pack(np.array(lengths))
        assert sorted(set(of)) == list(range(len(capacities)))
        used = np.bincount(of, lengths)
        assert all(c == min(x for x in packing.CAPACITIES if x >= u) for c, u in zip(capacities, used))
        ratios.append(total_work(capacities) / best_work(lengths, packing.CAPACITIES))
    assert max(ratios) < 1.45 and np.mean(ratios) < 1.05


@pytest.mark.parametrize("low, high, sizes", [(1, 200, {512}), (300, 500, {512, 1024, 2048}), (513, 4100, {1024, 2048, 4096, 8192}), (6000, 8192, {8192})])
def test_several_sizes_are_opened(low, high, sizes):
    r = np.random.default_rng(low)
    lengths = np.sort(r.integers(low, high + 1, 5000))[::-1]
    of, capacities = packing.pack(lengths)
    assert set(capacities) <= sizes | {512, 1024} and (len(sizes) == 1 or len(set(capacities)) > 1)
    alone = min(total_work(packing.pack(lengths, tuple(c for c in packing.CAPACITIES if c >= top))[1]) for top in (8192,))
    assert total_work(capacities) <= alone
    assert np.bincount(of, lengths).sum() == lengths.sum()


def test_a_large_group_of_near_copies(spark):
    """20,000 fingerprints around one: all link through few of them, and the rest of their buckets is skipped."""
    r = np.random.default_rng(5)
    centre = int(r.integers(0, 1 << 62))
    near = {centre}
    while len(near) < 20_000:
        near.add(centre ^ sum(1 << int(b) for b in set(r.choice(64, r.integers(1, 5)).tolist())) & (1 << 62) - 1)
    apart = [int(x) for x in r.integers(0, 1 << 62, 500)]
    fps = spark.createDataFrame([(i, x) for i, x in enumerate([*near, *apart])], "id long, fp long").repartition(4)
    named = {row.fp: row.c for row in simhash.labelled(fps).collect()}
    assert len(named) == len(near | set(apart))
    assert len({named[x] for x in near}) == 1
    lone = [x for x in apart if all((x ^ y).bit_count() > 4 for y in [*near, *apart] if y != x)]
    assert all(named[x] == x for x in lone) and len(lone) > 490


# --- fingerprints: buckets of ids ---------------------------------------------------
def ids(kind):
    r = random.Random(9)
    if kind == "wide":
        return [-9 * 10**18, 9 * 10**18, *range(200)]
    if kind == "outlier":
        return [9 * 10**18, *range(2000)]
    if kind == "repeated":
        return [7] * 1000 + list(range(500)) + [2**63 - 1] * 700
    if kind == "null":
        return [None] * 900 + list(range(300))
    return [r.choice([None, r.randint(-50, 50), r.randint(-(2**63), 2**63 - 1)]) for _ in range(900)]


@pytest.mark.parametrize("kind", ["wide", "outlier", "repeated", "null", "mixed"])
def test_ids_of_any_range_fall_into_even_buckets(spark, kind):
    from salesengine.llm import fingerprints

    r = random.Random(3)
    rows = [(i, r.choice([None, "", *[prose(3, k) for k in range(40)], f"{r.random()} é"])) for i in ids(kind)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = fingerprints.with_next(table).withColumn("part", F.spark_partition_id()).collect()
    own, ghosts = [x for x in got if not x.ghost], [x for x in got if x.ghost]
    order = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")
    want = sorted(rows, key=order, reverse=True)
    assert [(x.id, x.text) for x in sorted(own, key=lambda x: x.bucket)] == want  # rows of a bucket come in order
    buckets = sorted({x.bucket for x in own})
    firsts = {b: next((x.id, x.text) for x in own if x.bucket == b) for b in buckets}
    assert sorted((x.bucket, repr((x.id, x.text))) for x in ghosts) == sorted((b, repr(firsts[buckets[(k + 1) % len(buckets)]])) for k, b in enumerate(buckets))
    sizes = [sum(x.bucket == b for x in own) for b in buckets]
    copies = max(sum(y == x for y in rows) for x in rows)
    assert max(sizes) <= 4 * len(rows) / 8 / 2 + copies + 60, sizes
    assert fingerprints.against_edited(table).count() == len(rows)


def test_string_ids_are_an_error(spark):
    from salesengine.llm import fingerprints

    with pytest.raises(TypeError, match="integer ids"):
        fingerprints.with_next(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


# --- HTML extraction: names only hint ------------------------------------------------
@pytest.mark.parametrize("source, want", [
    ('<body><article class="post no-comments"><p>One two.</p></article></body>', "One two."),
    ('<article><p>A</p><div class="related-work"><p>B</p></div><div class="related-posts"><p>C</p></div></article>', "A\nB"),
    ('<article class="sponsored"><p>A</p><div id="notice-board">B</div><section class="comments-area">C</section></article>', "A\nB"),
    ('<article><p>A</p><div class="ad-728x90">B</div><div class="x cookie-banner">C</div><div class="without-sidebar">D</div></article>', "A\nD"),
    ('<p title="x>hello</p>', "hello"),
    ("<p title='it>one</p><p>two</p>", "one\ntwo"),
    ('<p title="a>b">three</p>', "three"),
])
def test_class_words_bar_only_what_they_name(source, want):
    assert template.main_text(source) == want


def test_a_long_page_of_quotes_is_read_in_time():
    assert template.main_text("<p " + '"' * 200_001 + ">text</p>") == "text"


# --- quality: verdicts against a plain EM ---------------------------------------------
def test_verdicts_equal_a_plain_em(spark):
    """The kept texts are those whose posterior by a loop over texts, not over vote patterns, is at least one half."""
    import pyarrow as pa

    from salesengine.llm.text import utf8

    r = random.Random(4)
    texts = [prose(r.randint(25, 300), i) for i in range(60)] + ["### $$$ | " * 30 + prose(30, i) for i in range(20)]
    texts += [(prose(12, i) + "\n") * 6 + prose(40, i + 7) for i in range(20)] + [None, "", "short text", " ".join("x%d" % k for k in range(60))]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x.doc_id: x for x in quality.score(table, quality.fit(table)).collect()}

    data, off = utf8(pa.array(texts, pa.large_string()))
    m, votes = quality.measure(data, off)
    failed = quality.base_failed(m)
    code = quality.pattern_code(votes)
    rules = list(quality.RULES)
    kinds = [[name in kind for name in rules] for kind in quality.KINDS.values()]
    rows = [[int(c) // 3**k % 3 for k in range(len(rules))] for c in code]
    used = [i for i in range(len(texts)) if not failed[i]]

    def start(v):
        bad = [x == 0 for x in v]
        post = [0.1 / len(kinds)] * (1 + len(kinds))
        doubtful = sum(bad) >= 2 or sum(bad) > sum(x == 2 for x in v)
        most = max(range(len(kinds)), key=lambda k: (sum(b and g for b, g in zip(bad, kinds[k])), -k))
        post[1 + most if doubtful else 0] = 0.9
        return [p / sum(post) for p in post]

    def posterior(v, prior, tables):
        p = [prior[c] * np.prod([tables[c][k][v[k]] for k in range(len(rules))]) for c in range(len(prior))]
        return [x / sum(p) for x in p]

    post = {i: start(rows[i]) for i in used}
    for _ in range(200):
        size = 1 + len(kinds)
        prior = [(sum(post[i][c] for i in used) + 1) / (len(used) + size) for c in range(size)]
        tables = []
        for c in range(size):
            tables.append([])
            for k in range(len(rules)):
                counts = [1 + sum(post[i][c] for i in used if rows[i][k] == x) for x in range(3)]
                tables[-1].append([x / sum(counts) for x in counts])
        was, post = post, {i: posterior(rows[i], prior, tables) for i in used}
        if max(abs(a - b) for i in used for a, b in zip(post[i], was[i])) < 1e-9:
            break
    for i in range(len(texts)):
        assert got[i].base_failed == bool(failed[i])
        good = posterior(rows[i], prior, tables)[0]
        assert got[i].kept == (not failed[i] and good >= 0.5) or abs(good - 0.5) < 1e-6
        assert failed[i] or abs(got[i].quality - good) < 1e-6
    assert 0 < sum(x.kept for x in got.values()) < len(texts) - 5
