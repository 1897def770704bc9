"""Document fingerprints by improved consistent weighted sampling.

A text's terms are its five-word shingles, weighted by how often they occur in it. For each
of ``SAMPLES`` samples a term has r, c ~ Gamma(2, 1) and beta ~ U(0, 1); with weight w,
t = floor(ln w / r + beta), ln a = ln c - r (t - beta) - r, and the sample is the (term, t)
of the smallest a. Two texts agree in a sample with the probability of their generalised
Jaccard similarity. The variates come from a table of 65,536 draws of (r, ln c, beta),
chosen by 16 bits of a hash of term and sample; 32 further bits break ties and name the
term, and 16 bits of each sample make the fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import shuffle_partitions
from .text import U, _odd, blocks, mix, span_hashes, utf8, windows, word_spans

SHINGLE = 5
SAMPLES = 64
_rng = np.random.Generator(np.random.PCG64(20240501))
R = _rng.gamma(2.0, 1.0, 1 << 16)
LOG_C = np.log(_rng.gamma(2.0, 1.0, 1 << 16))
BETA = _rng.random(1 << 16)


def _sortable(x: np.ndarray) -> np.ndarray:
    """Order-preserving high half of a 64-bit key for float values."""
    bits = x.astype(np.float32).view(np.int32)
    return ((bits ^ (bits >> 31 & 0x7FFFFFFF)).astype(np.int64) + (1 << 31)).astype(np.uint64) << U(32)


ONCE = _sortable(LOG_C + R * BETA - R)


def signatures(data: np.ndarray, off: np.ndarray, k: int = SHINGLE, samples: int = SAMPLES) -> np.ndarray:
    """Samples (texts x samples, 16 bits) of each text of a block; wordless texts have zeros."""
    out = np.zeros((len(off) - 1, samples), np.uint16)
    starts, ends, woff = word_spans(data, off)
    h, _, soff = windows(span_hashes(data, starts, ends), woff, k)
    if not len(h):
        return out
    for a, b in zip(soff[:-1].tolist(), soff[1:].tolist()):
        h[a:b].sort()
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[1:] != h[:-1]
    full = np.flatnonzero(np.diff(soff))
    fresh[soff[full]] = True
    first = np.flatnonzero(fresh)
    terms, weight = h[first], np.diff(np.append(first, len(h)))
    begin = np.searchsorted(first, soff[full])
    heavy = np.flatnonzero(weight > 1)
    log_w = np.log(weight[heavy])
    for s in range(samples):
        x = terms ^ U(_odd(1000 + s))
        x *= U(0x9E3779B97F4A7C15)
        x ^= x >> U(32)
        x *= U(0xD6E8FEB86659FD93)
        slot = x >> U(48)
        low = (x >> U(16)) & U(0xFFFFFFFF)
        key = ONCE[slot] | low
        if len(heavy):
            i = slot[heavy]
            t = np.floor(log_w / R[i] + BETA[i])
            name = low[heavy] ^ (mix(t.astype(np.int64).view(np.uint64) * U(0x9E3779B97F4A7C15)) & U(0xFFFFFFFF))
            key[heavy] = _sortable(LOG_C[i] - R[i] * (t - BETA[i]) - R[i]) | name
        out[full, s] = np.minimum.reduceat(key, begin).astype(np.uint16)
    return out


def of_column(col: pa.Array) -> np.ndarray:
    data, off = utf8(col)
    parts = [signatures(data[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in blocks(off)]
    return np.concatenate(parts) if parts else np.zeros((0, SAMPLES), np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, the estimate of the generalised Jaccard similarity."""
    return (a == b).mean(axis=1)


def _hex(sig: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes().hex() for row in sig.astype(">u2")], pa.string())


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint): 256 hex digits, four a sample. Null, empty and wordless texts have zeros,
    so they are alike; one to four words are one shingle. Repeated rows stay."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _hex(of_column(batch.column(1)))], names=["id", "fingerprint"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, fingerprint string")


def _place(borders: list[int], x):
    """How many of the rising ``borders`` are at most ``x``, by binary search."""
    if not borders:
        return F.lit(0)
    steps = F.lit([1 << k for k in reversed(range(len(borders).bit_length()))])
    known = F.lit(borders)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(borders)) & (F.try_element_at(known, at + step) <= x), at + step).otherwise(at))


def _text_key(text):
    """The first seven bytes of a text as a number in the same order; -1 for null."""
    return F.coalesce(F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long"), F.lit(-1))


def bucketed(rows: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(rows of (id, text) with their ``bucket`` and ``key``, number of buckets): ranges of falling id, nulls last.

    Borders are about ``n`` quantiles of the ids, whatever their range. An id that several quantiles fall on, or null if it
    has as many rows, is split further at quantiles of its texts' first bytes (``key``, else 0).
    """
    found, total, nulls = rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)] or [0.5], 10_000), F.count("*"), F.count_if(F.col("id").isNull())).first()
    found = found or []
    borders = sorted(set(found))
    heavy: dict[int | None, int] = {b: found.count(b) for b in borders if found.count(b) > 1}
    if total and nulls * n > total:
        heavy[None] = nulls * n // total
    key = _text_key(F.col("text")) if heavy else F.lit(0).cast("long")
    rows = rows.withColumn("key", key)
    cuts: dict[int | None, list[int]] = {}
    if heavy:
        is_ = lambda v: F.col("id").isNull() if v is None else F.col("id") == v
        got = rows.agg(*[F.percentile_approx(F.when(is_(v), F.col("key")), [k / (m + 1) for k in range(1, m + 1)], 10_000).alias(f"q{i}") for i, (v, m) in enumerate(heavy.items())]).first()
        cuts = {v: sorted(set(got[i] or [])) for i, v in enumerate(heavy)}
    # slots, from the smallest ids up: below the first border, the border itself if it is heavy, above it, ...
    sizes = [1]
    for b in borders:
        sizes += [len(cuts[b]) + 1 if b in cuts else 0, 1]
    after = np.concatenate([[0], np.cumsum(sizes[::-1])])
    first = [int(after[len(sizes) - 1 - s]) for s in range(len(sizes))]  # first bucket of each slot in falling order
    place = _place(borders, F.col("id"))
    minor = F.lit(0)
    for v, c in cuts.items():
        minor = F.when(F.col("id").eqNullSafe(F.lit(v).cast("long")), len(c) - _place(c, F.col("key"))).otherwise(minor)
    held = F.col("id").isin([F.lit(v) for v in cuts if v is not None]) if any(v is not None for v in cuts) else F.lit(False)
    slot = 2 * place - F.when(held, 1).otherwise(0)
    bucket = F.when(F.col("id").isNull(), F.lit(int(after[-1]))).otherwise(F.element_at(F.lit(first), slot + 1)) + minor
    return rows.withColumn("bucket", bucket.cast("int")), int(after[-1]) + len(cuts.get(None, [])) + 1


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Partitions of (bucket, ghost, id, text) in falling order of id, ties by falling text, nulls last.

    A bucket is a range of ids (``bucketed``), one partition each. After its rows comes, as a ghost, the first row of the next bucket
    that has any (after the last: of the first), so every row's successor follows in its own partition. Ids are integers (else an error).
    """
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col}: integer ids are needed")
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows, n = bucketed(plain, shuffle_partitions(docs.sparkSession))
    head = F.max(F.struct(F.col("id").isNotNull().alias("some"), "id", "key")).alias("head")
    heads = sorted((r["bucket"], r["head"]["id"], r["head"]["key"]) for r in rows.groupBy("bucket").agg(head).collect())
    follow = [(b, i, k, heads[at - 1][0]) for at, (b, i, k) in enumerate(heads)]
    ahead = docs.sparkSession.createDataFrame(follow, "of int, head_id long, head_key long, target int")
    match = (F.col("bucket") == F.col("of")) & F.col("id").eqNullSafe(F.col("head_id")) & (F.col("key") == F.col("head_key"))
    ghosts = rows.join(F.broadcast(ahead), match).groupBy("target", "head_id").agg(F.max("text").alias("text")).select(F.col("target").alias("bucket"), F.lit(1).alias("ghost"), F.col("head_id").alias("id"), "text")
    return (rows.select("bucket", F.lit(0).alias("ghost"), "id", "text").union(ghosts).repartitionById(n, F.col("bucket"))
            .sortWithinPartitions("bucket", "ghost", F.desc_nulls_last("id"), F.desc_nulls_last("text")))


def against_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's fingerprint beside that of its edited text and that of the next text.

    The edited text has its last third (floor of code points) replaced by as many first code
    points, or all, of the next text in falling order of id; the first text follows the last,
    and a single row follows itself. An empty table gives no rows. At most one block of texts
    is held at a time.
    """

    def finish(ids, texts, sigs, following, following_sig):
        nexts, next_sigs = [*texts[1:], following], np.concatenate([sigs[1:], following_sig[None]])
        edited = [t[: len(t) - len(t) // 3] + u[: len(t) // 3] for t, u in zip(texts, nexts)]
        edited_sigs = of_column(pa.array(edited, pa.large_string()))
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()), _hex(sigs), _hex(edited_sigs),
            pa.array(likeness(sigs, edited_sigs)), pa.array(likeness(sigs, next_sigs))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (ids, texts, signatures) whose following row is still to come
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                sigs = of_column(piece.column(3))
                bucket, ghost, ids, texts = (c.to_pylist() for c in piece.columns)
                i = 0
                while i < len(ids):
                    j = i
                    while j < len(ids) and (bucket[j], ghost[j]) == (bucket[i], ghost[i]):
                        j += 1
                    own = [t or "" for t in texts[i:j]]
                    if held:
                        yield finish(*held, own[0], sigs[i])
                        held = None
                    if ghost[i] == 0:
                        held = (ids[i:j], own, sigs[i:j])
                    i = j
        assert held is None, "a bucket ended without its ghost"

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return with_next(docs, id_col, text_col).mapInArrow(
        run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
