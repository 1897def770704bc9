"""Variable-capacity best-fit packing.

Documents go to packs of several permitted sequence lengths. Texts longer than the largest
capacity are cut into spans of that capacity and a rest. Within a shard the spans are placed
in order of falling length: into the open bin where the least room is left over, or, if none
fits, into a new bin. Its capacity is chosen among all that hold the span, jointly with what would
come beside it: each is filled on trial with the longest waiting spans that fit, and the least work for each token so held wins.
The work of a sequence is its length, an attention part that grows with the square, and a fixed overhead
(``work``), so long sequences aren't cheapest as such, and short ones only where they fill up. At the end each bin is downsized to the smallest permitted
capacity that holds its contents. Nothing is dropped.

Shards are blocks of at most ``BLOCK`` spans by a hash of the id, so memory is bounded and
no corpus-wide order is needed; a block wastes at most its last bins.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import shuffle_partitions
from .text import blocks, utf8, word_spans

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16
ATTENTION = 16_384
BLOCK = 65_536
SCHEMA = "bin_id string, capacity int, position int, offset int, doc_id {kind}, span_start long, n_tokens int, used int"


def work(capacity: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    """Cost of one sequence: attention adds as much as all the rest at a length of ``attention`` tokens."""
    return capacity * (1 + capacity / attention) + overhead


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION) -> tuple[list[int], list[int]]:
    """(bin of each length, capacity of each bin); lengths fall and are at most the largest capacity."""
    kinds, counts = (x.tolist() for x in np.unique(lengths, return_counts=True))
    waiting = dict(zip(kinds, counts))

    def held(size: int, capacity: int) -> int:
        """Tokens in a new bin that takes ``size`` and then the longest waiting spans that fit, again and again."""
        room, at = capacity - size, len(kinds)
        while (at := min(at, bisect_right(kinds, room)) - 1) >= 0:
            room -= kinds[at] * min(waiting[kinds[at]], room // kinds[at])
        return capacity - room

    bins: list[int] = []
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    used: list[int] = []
    for size in lengths.tolist():
        waiting[size] -= 1
        if not waiting[size]:
            kinds.pop()  # lengths fall, so the longest kind ends first
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            b = len(used)
            used.append(0)
            left = min((c for c in capacities if c >= size), key=lambda c: (work(c, overhead, attention) / held(size, c), c))
        used[b] += size
        bins.append(b)
        if left > size:
            insort(room, (left - size, b))
    return bins, [min(c for c in capacities if c >= u) for u in used]


def spans(docs: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", largest: int = CAPACITIES[-1]) -> DataFrame:
    """(id, span_start, n_tokens): each document's spans of at most ``largest`` tokens; empty ones have none."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(largest).cast("long"))
    return (docs.select(F.col(id_col).alias("id"), F.col(length_col).cast("long").alias("n")).where("n > 0")
            .select("id", "n", F.explode(starts).alias("span_start"))
            .select("id", "span_start", F.least(F.lit(largest), F.col("n") - F.col("span_start")).cast("int").alias("n_tokens")))


def best_fit(docs: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", capacities: tuple[int, ...] = CAPACITIES,
             overhead: int = OVERHEAD, block: int = BLOCK) -> DataFrame:
    """One row per span: bin_id, capacity, position and offset in the bin, id, span_start, n_tokens, used.

    ``span_start`` counts tokens from the start of the document. Null or non-positive lengths
    have no span; null ids are packed like any other; repeated rows are packed as often as
    they come (ties in length are placed by id, then span). An empty table gives no rows.
    Two runs over the same rows with the same number of shuffle partitions give the same bins.
    """
    capacities = tuple(sorted(capacities))
    kind = docs.schema[id_col].dataType.simpleString()
    shards = shuffle_partitions(docs.sparkSession)
    names = ["bin_id", "capacity", "position", "offset", "doc_id", "span_start", "n_tokens", "used"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        count = number = 0

        def flush():
            nonlocal number
            t = pa.Table.from_batches(held).to_pandas(types_mapper=pd.ArrowDtype).sort_values(
                ["n_tokens", "id", "span_start"], ascending=[False, True, True], kind="stable")
            n = t["n_tokens"].to_numpy(np.int64)
            of, caps = pack(n, capacities, overhead)
            of, caps = np.array(of), np.array(caps)
            order = np.argsort(of, kind="stable")
            t, n, of = t.iloc[order], n[order], of[order]
            fresh = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            sizes = np.diff(np.append(fresh, len(of)))
            before = np.cumsum(n) - n
            used = np.add.reduceat(n, fresh)
            label = f"{t['shard'].iloc[0]}-{number}-"
            number += 1
            return pa.RecordBatch.from_arrays([
                pa.array([label + str(b) for b in of.tolist()]), pa.array(caps[of].astype(np.int32)),
                pa.array((np.arange(len(of)) - np.repeat(fresh, sizes)).astype(np.int32)),
                pa.array((before - np.repeat(before[fresh], sizes)).astype(np.int32)),
                pa.array(t["id"]), pa.array(t["span_start"]), pa.array(t["n_tokens"]), pa.array(np.repeat(used, sizes).astype(np.int32))], names=names)

        for batch in batches:
            for i in range(0, batch.num_rows, block):
                piece = batch.slice(i, block)
                while piece.num_rows:
                    take = min(block - count, piece.num_rows)
                    held.append(piece.slice(0, take))
                    count += take
                    piece = piece.slice(take)
                    if count == block:
                        yield flush()
                        held, count = [], 0
        if count:
            yield flush()

    dealt = (spans(docs, id_col, length_col, capacities[-1])
             .withColumn("shard", F.pmod(F.xxhash64("id", "span_start"), F.lit(shards)).cast("int"))
             .repartitionById(shards, F.col("shard")).sortWithinPartitions("id", "span_start", "n_tokens"))
    return dealt.mapInArrow(run, SCHEMA.format(kind=kind))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens): white-space words of each whole text plus one end mark; a null text has the mark only."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, off = utf8(batch.column(1))
            parts = [np.diff(word_spans(data[off[i] : off[j]], off[i : j + 1] - off[i])[2]) + 1 for i, j in blocks(off)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))], names=[id_col, "n_tokens"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long")
