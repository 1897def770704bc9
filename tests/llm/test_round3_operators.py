"""Prefix trie, substring removal and vector codes against brute-force versions, and their edge cases."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesengine.llm import codes, queries, substrings, trie
from salesengine.llm.tables import split_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- conversation prefix trie ------------------------------------------------------
def brute_trie(seqs):
    """seqs: conv id -> list of (role, text)."""
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {p: {q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p} for p in members}
    out = set()
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(WORD.findall(q[-1][1])) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p))))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), sum(not children[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def brute_rebuilt(own):
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + seq[h:]
    return out


def dialogues():
    r = random.Random(5)
    rows = []
    common = [("user", "hello there  you"), ("assistant", "yes\tthis is it"), ("user", "ok")]
    for c in range(150):
        if c % 3 == 0:
            seq = common  # a third of all conversations are the same
        else:
            seq = common[: r.randint(0, 3)] + [(r.choice(["user", "assistant", ""]), " ".join(r.choice("abc") for _ in range(r.randint(0, 2)))) for _ in range(r.randint(0, 4))]
        if not 20 <= c < 40 or c % 20:
            rows += [(c, i, role, text) for i, (role, text) in enumerate(seq)]
    rows += [(500, i, "user", "long" + str(i)) for i in range(300)] + [(501, i, "user", "long" + str(i)) for i in range(301)]
    rows += [(502, None, None, None), (502, 1, "user", None), (502, 2, None, "x " * 30_000), (-7, 0, "user", "a")]
    return rows


@pytest.mark.parametrize("limit", [1, 7, trie.SHARD])
def test_trie_is_that_of_brute_force(spark, limit):
    rows = dialogues()
    own = {}
    for c, _, role, text in rows:
        own.setdefault(c, []).append((role or "", text or ""))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumn("path", F.lit(1)).withColumn("key", F.lit("x"))
    got = trie.nodes(trie.rebuilt(trie.paths(table)), limit).collect()
    want = brute_trie(brute_rebuilt(own))
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_trie_of_repeated_turns_null_ids_and_nothing(spark):
    kind = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "b", "x"), (1, 0, "a", "y"), (1, 0, "a", "y"), (None, 0, "a", "y"), (4, 0, "u", "z")]
    got = trie.nodes(trie.paths(spark.createDataFrame(rows, kind)))
    assert set(map(tuple, got.collect())) == brute_trie({1: [("a", "y"), ("a", "y"), ("b", "x")], 4: [("u", "z")]})
    assert trie.nodes(trie.rebuilt(trie.paths(spark.createDataFrame([], kind)))).count() == 0
    # conversation 2 is left without a turn: its base is absent and its own turns are the replaced ones
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(1, 20)}
    c = next(c for c in h if h[c] == 2)
    only = trie.nodes(trie.rebuilt(trie.paths(spark.createDataFrame([(c, 0, "u", "z"), (c, 1, "u", "z")], kind)))).collect()
    assert set(map(tuple, only)) == brute_trie({c: []})


def test_search_tree_is_balanced():
    shard = trie.Shard()
    for i in range(1023):
        name = i.to_bytes(16, "big")
        shard.add(i, (name,), [1])
    tree = shard.tree()

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.low[at]), height(tree.high[at]))

    assert height(tree.down[0]) == 10


# --- repeated passages --------------------------------------------------------------
def brute_removed(rows, window):
    first = {}
    texts = [(2**63 - 1 if i is None else i, WORD.findall(t or "")) for i, t in rows]
    for i, w in texts:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), (given, _) in zip(texts, rows):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        out.append((given, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def passages(window):
    r = random.Random(11)
    words = ["é" * r.randint(1, 3) + str(k) for k in range(4000)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    shared, hot = text(window + 30), text(window)
    line = text(7)
    rows = []
    for i in range(120):
        parts = [text(r.randint(0, 80))]
        for _ in range(r.randint(0, 3)):
            a = r.randint(0, 30)
            parts += [shared[a : a + r.choice([window - 1, window, window + 1])], text(r.randint(0, 40))]
        if i % 3 == 0:
            parts += [hot, text(3)]
        if i % 10 == 0:
            parts += [line * 30]
        rows.append((i * 7 % 121, r.choice([" ", "\n", " \t "]).join(sum(parts, []))))
    rows += [(900 + i, rows[i % 2][1]) for i in range(40)]  # copies
    rows += [(5, None), (6, ""), (7, " \n "), (8, "word"), (None, " ".join(shared)), (None, " ".join(shared) + " more"), (900, rows[0][1]), (3, " ".join(text(9) + hot)), (3, " ".join(hot + text(9)))]
    rows += [(2000, " ".join(text(30_000) + shared)), (-4, "x" * 200_000)]
    return rows


@pytest.mark.parametrize("window", [50, 32])
def test_removed_words_are_those_of_brute_force(spark, window):
    rows = passages(window)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).withColumn("digest", F.lit(0)).withColumn("a.b", F.lit(0))
    got = substrings.remove_repeats(table, window=window)
    assert got.columns == ["id", "n_words", "n_removed", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_removed(rows, window)
    hashed = {(r.id, r.n_words, r.kept_sha256) for r in substrings.remove_repeats(table, window=window, with_text=False).collect()}
    assert hashed == {(i, n, hashlib.sha256(k.encode()).hexdigest()) for i, n, _, k in brute_removed(rows, window)}


def test_cover_holds_every_difference():
    assert {(a - b) % substrings.PERIOD for a, b in itertools.product(substrings.COVER, repeat=2)} == set(range(substrings.PERIOD))


def test_removal_from_nothing_and_of_bad_ids(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(TypeError, match="integer ids"):
        substrings.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
    with pytest.raises(ValueError, match="window"):
        substrings.remove_repeats(spark.createDataFrame([(1, "b")], "doc_id long, text string"), window=20)


# --- vector codes ---------------------------------------------------------------------
def brute_codes(rows, rounds=codes.ROUNDS):
    """rows: (id, label, list of ints) in order of id."""
    width = len(rows[0][2]) // 8
    parts = [[r[2][p * width : (p + 1) * width] for r in rows] for p in range(8)]
    books = [x[:16] for x in parts]
    dist = lambda a, b: sum((u - v) ** 2 for u, v in zip(a, b))
    nearest = lambda x, book: min((dist(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            of = [nearest(x, books[p])[1] for x in parts[p]]
            books[p] = [[sum(c) // len(c) for c in zip(*(x for x, o in zip(parts[p], of) if o == i))] if i in of else e for i, e in enumerate(books[p])]
    final = [[nearest(x, books[p]) for x in parts[p]] for p in range(8)]
    return [("".join(f"{final[p][k][1]:02x}" for p in range(8)), sum(final[p][k][0] for p in range(8))) for k in range(len(rows))], books


def vectors(n, seed, spread=1.0):
    r = random.Random(seed)
    return [[r.choice([-1, 0, 1, 0.5]) * spread if seed % 2 else r.gauss(0, spread) for _ in range(24)] for _ in range(n)]


@pytest.mark.parametrize("n, seed", [(300, 1), (300, 2), (9, 2), (40, 3)])
def test_codes_are_those_of_brute_force(spark, n, seed):
    found = vectors(n, seed)
    found[n // 2 :: 3] = [found[0]] * len(found[n // 2 :: 3])
    rows = [(i * 3, v, [None, 1, 2][i % 3]) for i, v in enumerate(found)]
    bad = [(1, None, 1), (2, [None] * 24, 1), (4, [float("nan")] + [0.0] * 23, 1), (5, [float("inf")] * 24, 2), (-1, [-float("inf")] * 24, None)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").repartition(3).withColumn("codes", F.lit(1)).withColumn("x", F.lit(1))
    ints = [(i, label, [math.floor(4096 * float(np.float32(x))) for x in v]) for i, v, label in rows]
    want, books = brute_codes(ints)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    of_label = {x: sum(e for (_, e), r in zip(want, rows) if r[2] == x) for x in (None, 1, 2)}
    got = codes.digest(*codes.compress(table))
    assert sorted(map(tuple, got.collect())) == [(i, c, e, of_label[label], sha) for (c, e), (i, _, label) in zip(want, rows)]


def test_fixed_parts_meet_only_moved_entries():
    r = np.random.default_rng(1)
    x = r.integers(-3, 4, (500, 3))
    old, new = r.integers(-3, 4, (16, 3)), r.integers(-3, 4, (16, 3))
    new[:9] = old[:9]
    code, dist = np.full(500, -1), np.zeros(500, np.int64)
    codes.assign(x, old, np.ones(16, bool), code, dist)
    codes.assign(x, new, (new != old).any(axis=1), code, dist)
    d = codes.distances(x, new)
    assert (code == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()


def test_codes_of_odd_vectors(spark):
    kind = "vec_id long, embedding array<double>, label int"
    coded, books = codes.compress(spark.createDataFrame([], kind))
    assert codes.digest(coded, books).count() == 0
    null_ids = spark.createDataFrame([(None, [float(i)] * 8, None) for i in range(20)] + [(7, [1.0] * 8, 3)] * 2, kind)
    assert codes.digest(*codes.compress(null_ids)).count() == 22
    for odd, message in (([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], "lengths from 8 to 16"), ([(1, [1.0] * 9, 1)], "one length that 8 divides")):
        with pytest.raises(ValueError, match=message):
            codes.compress(spark.createDataFrame(odd, kind))
    with pytest.raises(Exception, match="is not below"):
        codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], kind))


def test_split_is_crc(spark):
    got = {r.id for r in spark.range(50).where(split_of("id", 7, 2)).collect()}
    assert got == {i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2}
    assert {"op11_trie", "op12_substrings", "op13_vector_codes"} <= set(queries.ORACLE_SQL)
