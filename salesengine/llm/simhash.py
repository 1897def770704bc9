"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments (22, 21 and 21 bits), each read as a word
of the perfect binary Golay code [23, 12, 7]. Every word decodes to one codeword; its
*keys* are the codewords that it and its one-bit neighbours decode to (one or about six).
Two words that differ in one bit: each one's own codeword is among the other's keys.

Pigeonhole for at most four differing bits over three segments: either one segment is
equal, or two segments differ in exactly one bit each. So candidates are the pairs with an
equal segment, or with a pair (i, j) of segments where the left's own codeword of i and
keys of j meet the right's keys of i and own codeword of j. Candidates are verified on all
64 bits in the join. Larger distances than four are refused, as the argument ends there.

Copies collapse to one row per distinct fingerprint before the join. Links are found in
two rounds: every fingerprint against up to three of each of its buckets (the smallest, the largest and that
of the smallest hash), then all against all, but for buckets of ``LARGE`` rows or more that hold one component by then. So a
large group of near copies, whose members are near these, costs comparisons in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .tables import cut
from .text import LOWER, SPACE, U, blocks, utf8, word_spans

SHINGLE = 4
MAX_BITS = 4
SEED = 42
LARGE = 64
WIDTHS = (22, 21, 21)
#: Fixed value: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the Golay code.
GENERATOR = 0b110001110101
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


@cache
def golay() -> tuple[np.ndarray, np.ndarray]:
    """(byte-wise syndrome tables, error pattern of each of the 2048 syndromes)."""
    rest = []
    for bit in range(23):
        r = 1 << bit
        for top in range(bit, 10, -1):
            if r >> top & 1:
                r ^= GENERATOR << (top - 11)
        rest.append(r)
    error = np.full(2048, -1, np.int64)
    error[0] = 0
    frontier = {0: 0}
    for _ in range(3):
        frontier = {s ^ rest[b]: e | 1 << b for s, e in frontier.items() for b in range(23) if not e >> b & 1}
        for s, e in frontier.items():
            if error[s] < 0:
                error[s] = e
    parts = np.zeros((3, 256), np.int64)
    for k in range(3):
        for v in range(256):
            for b in range(8):
                if v >> b & 1 and 8 * k + b < 23:
                    parts[k, v] ^= rest[8 * k + b]
    return parts, error


def codeword(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word; it is at most 3 bits away."""
    parts, error = golay()
    syndrome = parts[0][words & 255] ^ parts[1][words >> 8 & 255] ^ parts[2][words >> 16 & 255]
    return (words ^ error[syndrome]) >> 11


def segments(fp: np.ndarray) -> list[np.ndarray]:
    out, at, bits = [], 0, fp.view(np.uint64)
    for w in WIDTHS:
        out.append((bits >> U(at) & U((1 << w) - 1)).astype(np.int64))
        at += w
    return out


def join_keys(fp: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """(row, key) arrays of the left and the right side of the candidate join."""
    segs = segments(fp)
    rows = np.arange(len(fp))
    own = [codeword(s) for s in segs]
    near = []
    for s, w in zip(segs, WIDTHS):
        ball = np.sort(np.stack([codeword(s)] + [codeword(s ^ (1 << b)) for b in range(w)], axis=1), axis=1)
        fresh = np.ones(ball.shape, bool)
        fresh[:, 1:] = ball[:, 1:] != ball[:, :-1]
        near.append((np.nonzero(fresh)[0], ball[fresh]))
    equal = [(rows, np.int64(i) << 40 | s) for i, s in enumerate(segs)]
    left, right = list(equal), list(equal)
    for tag, (i, j) in enumerate(((0, 1), (0, 2), (1, 2)), start=3):
        r, k = near[j]
        left.append((r, np.int64(tag) << 40 | own[i][r] << 12 | k))
        r, k = near[i]
        right.append((r, np.int64(tag) << 40 | k << 12 | own[j][r]))
    return {side: tuple(map(np.concatenate, zip(*parts))) for side, parts in (("left", left), ("right", right))}


def fingerprints_of(data: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """SimHash of each text of a block (see ``simhash``)."""
    starts, ends, woff = word_spans(data, off)
    n = np.diff(woff)
    out = np.zeros(len(n), np.uint64)
    if not len(starts):
        return out
    gap = SPACE[data]
    kept = ~gap
    last = np.zeros(len(starts), bool)
    last[woff[1:][n > 0] - 1] = True
    kept[ends[~last]] = True
    clean = np.where(gap, np.uint8(32), LOWER[data])[kept]
    place = np.cumsum(kept)
    starts, ends = place[starts] - 1, place[ends - 1]
    many = np.where(n > 0, np.maximum(n - k + 1, 1), 0)
    soff = np.zeros(len(n) + 1, np.int64)
    np.cumsum(many, out=soff[1:])
    first = np.repeat(woff[:-1] - soff[:-1], many) + np.arange(soff[-1])
    final = np.minimum(first + k, np.repeat(woff[1:], many)) - 1
    buf, digest = clean.tobytes(), xxhash.xxh64_intdigest
    h = np.array([digest(buf[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[final].tolist())], np.uint64)
    # bit counts: one byte lane per bit, summed over at most 255 shingles at a time
    texts = np.flatnonzero(many)
    pieces = -(-many[texts] // 255)
    poff = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pieces, out=poff[1:])
    begin = np.repeat(soff[texts], pieces) + 255 * (np.arange(poff[-1]) - np.repeat(poff[:-1], pieces))
    counts = np.empty((len(texts), 64), np.int64)
    lanes = h.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        sums = np.add.reduceat(_LANES[lanes[:, byte]], begin).view(np.uint8).reshape(-1, 8)
        counts[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(sums, poff[:-1], axis=0, dtype=np.int64)
    bits = (2 * counts > many[texts][:, None]).astype(np.uint8)
    out[texts] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """(id, fp long): SimHash over XXH64 of the lower-cased k-word shingles, repeats included.

    A bit is 1 if set in over half the shingle hashes. Null, empty and wordless texts have
    fingerprint 0; fewer than k words are one shingle. Null ids stay rows. Rows are mapped
    one by one, so repeated rows stay repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(1))
            parts = [fingerprints_of(data[off[i] : off[j]], off[i : j + 1] - off[i], k) for i, j in blocks(off)]
            fp = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, fp long")


def with_simhash(docs: DataFrame, text_col: str = "text", k: int = SHINGLE, name: str = "__fp") -> DataFrame:
    """All columns of ``docs`` plus the text's fingerprint (see ``simhash``)."""
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(at))
            parts = [fingerprints_of(data[off[i] : off[j]], off[i : j + 1] - off[i], k) for i, j in blocks(off)]
            fp = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], names=schema.names)

    return docs.mapInArrow(run, schema)


def _side(fps: DataFrame, side: str, extra: str = "") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, key = join_keys(np.asarray(batch.column(0)))[side]
            yield pa.RecordBatch.from_arrays([c.take(pa.array(rows)) for c in batch.columns] + [pa.array(key)], names=[*batch.schema.names, "key"])

    return fps.mapInArrow(run, f"fp long{extra}, key long")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(nodes, spanning links) of distinct fingerprints ``fp`` at most ``max_bits`` bits apart.

    The links connect exactly what all pairs within the distance connect.
    """
    if max_bits > 4:
        raise ValueError("three segments and one-bit keys cover at most 4 differing bits")
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits
    left, right = _side(fps, "left"), _side(fps, "right")
    chosen = left.groupBy("key").agg(F.array_distinct(F.array(F.min("fp"), F.max("fp"), F.min_by("fp", F.xxhash64("fp")))).alias("of"))
    stars = (right.withColumnRenamed("fp", "b").join(chosen, "key").withColumn("a", F.explode("of"))
             .where((F.col("a") != F.col("b")) & near("a", "b")).select("a", "b").distinct())
    stars = cut(stars)
    label = components(stars, "a", "b")
    known = cut(fps.join(label, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("c")))
    one = _side(known, "left", ", c long").select("key", F.col("fp").alias("a"), F.col("c").alias("ca"))
    two = _side(known, "right", ", c long").select(F.col("key").alias("met"), F.col("fp").alias("b"), F.col("c").alias("cb"))
    # large buckets of one component have nothing to tell
    both = one.select("key", F.col("ca").alias("c")).union(two.select("met", "cb"))
    told = (both.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
            .where((F.col("n") >= LARGE) & (F.col("low") == F.col("high"))).select("k"))
    one = one.join(told, F.col("key") == F.col("k"), "left_anti")
    two = two.join(told, F.col("met") == F.col("k"), "left_anti")
    rest = (one.join(two, (F.col("key") == F.col("met")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & near("a", "b"))
            .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    return known, cut(rest)


def labelled(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, c, first) of each distinct fingerprint of (id, fp): its component, named by a fingerprint, and its smallest id."""
    fps = cut(prints.groupBy("fp").agg(F.min("id").alias("first")))
    known, rest = links(fps.select("fp"), max_bits)
    top = components(rest, "a", "b").select(F.col("node").alias("c"), F.col("component").alias("top"))
    label = known.join(top, "c", "left").select("fp", F.coalesce("top", "c").alias("c"))
    return cut(label.join(fps, "fp").select("fp", "c", "first"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with the columns of ``docs``: that of the smallest id, nulls last.

    Ids may be null or repeated: components, not ids, are reduced. Of a component's rows that
    repeat the id, one of the smallest text stays, and of rows that repeat both the one whose other columns have the smallest hash.
    Columns may have any names and types. Copies are combined in the map tasks.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # no name of the input meets one of ours
    id_, text = (f"c{names.index(c)}" for c in (id_col, text_col))
    named = labelled(simhash(plain, id_, text, k), max_bits)
    order = F.struct(F.col("first").isNull().alias("none"), "first")
    best = named.groupBy("c").agg(F.min(order).alias("best"))
    chosen = named.join(best, "c").where(order == F.col("best")).select("fp", "c")
    others = [f for f in plain.schema.fields if f.name not in (id_, text)]
    hashed = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in others]
    place = F.struct(F.col(id_).isNull().alias("none"), F.col(id_).alias("id"), F.col(text).alias("text"), F.xxhash64(*hashed, F.lit(0)).alias("rest"))
    copies = (with_simhash(plain, text, k, "fp").withColumn("place", place)
              .groupBy("fp").agg(F.min("place").alias("place"), F.min_by(F.struct(*plain.columns), "place").alias("row")))
    kept = copies.join(chosen, "fp").groupBy("c").agg(F.min_by("row", "place").alias("row"))
    return kept.select("row.*").toDF(*names)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp long, component) per row of ``docs``: the smallest id reachable over links.

    Fingerprints link at ``max_bits`` or fewer differing bits; equal ones always do. Null ids
    belong to their component but never name it unless it has no other id. An empty table
    gives no rows.
    """
    prints = cut(simhash(docs, id_col, text_col, k))
    named = labelled(prints, max_bits)
    names = named.groupBy("c").agg(F.min("first").alias("component"))
    of_print = named.join(names, "c").select("fp", "component")
    return prints.join(of_print, "fp").select("id", "fp", "component")
