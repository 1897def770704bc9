"""Vector codes by product quantisation, trained with an active-entry Lloyd iteration.

Vectors become integers and are cut into equal parts; each part position has a codebook of
``ENTRIES`` integer entries. Every row keeps, for each part, its entry and the exact squared
distance to it. After an update, a part whose own entry stayed fixed compares only the entries that
moved against that distance: the fixed ones were no nearer before, and are no nearer now. A part
whose entry moved rescans all. Ties go to the lower index either way.

A round is one pass that writes the rows with their state to the shared folder, and one that sums
the parts of each entry (reduced in the map tasks to one row an entry and component). Only
codebooks, of a fixed size, pass through the driver; a lost executor repeats a round's tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import cut

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Scaled components are below this in size, so that squared distances and their sums over a vector are exact longs.
LIMIT = 1 << 26
ROWS = 4096


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (rows x entries) of integer parts."""
    return ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)


def assign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, dist: np.ndarray) -> None:
    """Nearest entries of the parts ``x`` (rows x components) after an update, in place.

    ``moved`` marks the entries that the update changed; ``code`` and ``dist`` are the state
    before it, with code -1 where there is none yet.
    """
    stale = (code < 0) | moved[code]
    again = np.flatnonzero(stale)
    if len(again):
        d = distances(x[again], entries)
        code[again] = d.argmin(axis=1)
        dist[again] = d.min(axis=1)
    fixed, changed = np.flatnonzero(~stale), np.flatnonzero(moved)
    if len(fixed) and len(changed):
        d = distances(x[fixed], entries[changed])
        near, best = changed[d.argmin(axis=1)], d.min(axis=1)
        better = (best < dist[fixed]) | (best == dist[fixed]) & (near < code[fixed])
        code[fixed[better]] = near[better]
        dist[fixed[better]] = best[better]


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(-1, width)


def integers(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, int]:
    """(id, label, x array<int>) of the rows whose vector is whole and finite, and their length (0 without rows).

    Vectors of several lengths, or of a length that the parts don't divide, are an error, and so is a
    component that is not below LIMIT once scaled.
    """
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    whole = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), vec.alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", bad))
    scaled = F.transform("v", lambda x: F.floor(x * SCALE))
    too_large = F.exists("v", lambda x: F.abs(x) * SCALE >= LIMIT)
    x = F.when(too_large, F.raise_error(F.lit(f"a component times {SCALE} is not below {LIMIT}"))).otherwise(scaled).cast("array<int>")
    rows = cut(whole.select("id", "label", x.alias("x")))
    low, high = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if low is None:
        return rows, 0
    if low != high or high == 0 or high % PARTS:
        raise ValueError(f"{vec_col}: lengths from {low} to {high}; one length that {PARTS} divides is needed")
    return rows, high


def first_entries(rows: DataFrame, width: int) -> np.ndarray:
    """Starting codebooks (parts x entries x components): the rows of the smallest ids, ties by vector, nulls last."""
    found = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    return np.array([r.x for r in found], np.int64).reshape(len(found), PARTS, width // PARTS).swapaxes(0, 1).copy()


def assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray, width: int) -> DataFrame:
    """The rows with ``codes`` (one byte a part) and ``dist`` after the update that moved ``moved`` (parts x entries)."""
    fresh = "codes" not in rows.columns
    fields = [*rows.schema.fields[:3], T.StructField("codes", T.BinaryType()), T.StructField("dist", T.ArrayType(T.LongType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), width).astype(np.int64).reshape(-1, PARTS, width // PARTS)
            n = len(x)
            if fresh:
                code, dist = np.full((n, PARTS), -1, np.int64), np.zeros((n, PARTS), np.int64)
            else:
                code = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, PARTS).astype(np.int64)
                dist = _matrix(batch.column(4), PARTS).copy()
            for at in range(0, n, ROWS):
                s = slice(at, at + ROWS)
                for p in range(PARTS):
                    c, d = code[s, p].copy(), dist[s, p].copy()
                    assign(x[s, p], books[p], moved[p], c, d)
                    code[s, p], dist[s, p] = c, d
            flat = np.arange(n + 1) * PARTS
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([r.tobytes() for r in code.astype(np.uint8)], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(flat, pa.int32()), pa.array(dist.ravel()))], names=[f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields))


def updated(state: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """Codebooks of the componentwise floor means; an unused entry stays."""
    each = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((PARTS, ENTRIES, each), np.int64), np.zeros((PARTS, ENTRIES), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width).reshape(-1, PARTS, each)
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, PARTS)
            for p in range(PARTS):
                count[p] += np.bincount(code[:, p], minlength=ENTRIES)
                for e in np.unique(code[:, p]).tolist():
                    total[p, e] += x[code[:, p] == e, p].sum(axis=0, dtype=np.int64)
        p, e, at = (i.ravel() for i in np.indices(total.shape))
        used = count[p, e] > 0
        yield pa.RecordBatch.from_arrays([pa.array(c[used].astype(np.int64)) for c in (p, e, at, total.ravel(), count[p, e])], names=["p", "e", "at", "total", "n"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    out = books.copy()
    for r in state.select("x", "codes").mapInArrow(run, "p long, e long, at long, total long, n long").groupBy("p", "e", "at").agg(exact("total"), exact("n")).collect():
        out[r.p, r.e, r.at] = int(r.total) // int(r.n)
    return out


def train(rows: DataFrame, width: int, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(rows with their final codes and distances, final codebooks)."""
    books = first_entries(rows, width)
    moved = np.ones(books.shape[:2], bool)
    state = rows
    for _ in range(rounds):
        state = cut(assigned(state, books, moved, width))
        new = updated(state, books, width)
        moved = (new != books).any(axis=2)
        books = new
        if not moved.any():  # nor would any later round move one
            return state, books
    return cut(assigned(state, books, moved, width)), books


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((id, label, codes binary, error), codebooks): ``error`` sums the squared distances of a row's parts.

    Rows whose vector is null or has a null or non-finite component are left out. Components are scaled
    by SCALE and floored (see ``integers`` for what is an error). The codebooks start from the rows of the
    smallest ids (nulls last; rows of one id by vector), of which there may be fewer than ENTRIES. Null
    and repeated ids and labels stay rows; other columns are ignored. Without rows the result has none.
    """
    rows, width = integers(vectors, id_col, vec_col, label_col)
    if not width:
        return rows.select("id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error")), np.zeros((PARTS, 0, 0), np.int64)
    state, books = train(rows, width, rounds)
    return state.select("id", "label", "codes", F.aggregate("dist", F.lit(0).cast("long"), lambda a, d: a + d).alias("error")), books


def digest(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, code hex, error, label_error, codebooks_sha256) of a ``compress`` result; null labels are one label."""
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("__label")))
            .select("id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(sha).alias("codebooks_sha256")))
