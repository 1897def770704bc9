"""Removal of passages that an earlier document holds, by difference-cover anchors.

A window is ``WINDOW`` consecutive words of one text. Positions whose remainder modulo ``PERIOD``
is in ``COVER`` are *anchors*, hashed over ``WINDOW - PERIOD + 1`` words. The cover
holds every difference modulo the period, so two equal windows at any two positions have an
offset below the period at which both have an anchor, and these anchors are equal. An anchor
that only one text holds therefore rules its windows out; about a fifth of the positions is
hashed and shuffled, instead of all.

1. Anchors of all texts; one that two different texts hold is *live*. Map tasks reduce
   each batch first: an anchor that several texts of a batch hold is known to be live there,
   and one row stands for it in the shuffle, however common it is.
2. Texts meet their live anchors. Copies of a text are decided by its digest and smallest id.
3. Live anchors extend: every window around one is compared on 128 bits, the smallest id of
   each wins (again reduced by batch first), and covered words go.

Only texts with a live anchor are written between the steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut
from .text import U, _odd, blocks, mix, span_hashes, utf8, word_spans

WINDOW = 50
#: A perfect difference cover modulo 31 (every remainder is a difference of two of its six members).
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
_COVERED = np.isin(np.arange(PERIOD), COVER)
#: A null id counts as this one, the largest.
LAST = (1 << 63) - 1


@cache
def _factors(k: int, lane: int) -> list[np.uint64]:
    return [U(_odd(5000 + 1000 * lane + j)) for j in range(k)]


def hashes_at(h: np.ndarray, first: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hash of the ``k`` word hashes from each position of ``first`` on."""
    out = np.zeros(len(first), np.uint64)
    for j, factor in enumerate(_factors(k, lane)):
        out += h[first + j] * factor
    return mix(out)


def window_starts(woff: np.ndarray, k: int) -> np.ndarray:
    """Positions, over all texts of a block, at which ``k`` words of one text begin."""
    last = np.repeat(woff[1:], np.diff(woff))
    at = np.arange(woff[-1])
    return at[at + k <= last]


def text_of(woff: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(woff, at, "right") - 1


def anchors(h: np.ndarray, woff: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of a block."""
    k = window - PERIOD + 1
    at = window_starts(woff, k)
    at = at[_COVERED[(at - np.repeat(woff[:-1], np.maximum(np.diff(woff) - k + 1, 0))) % PERIOD]]
    return at, hashes_at(h, at, k)


def by_block(col: pa.Array):
    """(first text, bytes, word starts, word ends, first words, word hashes) of each block of a column."""
    data, off = utf8(col)
    for i, j in blocks(off):
        part = data[off[i] : off[j]]
        starts, ends, woff = word_spans(part, off[i : j + 1] - off[i])
        yield i, part, starts, ends, woff, span_hashes(part, starts, ends)


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, woff: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    kept = np.flatnonzero(keep)
    total = np.concatenate([[0], np.cumsum(keep)])
    begin, end = total[woff[:-1]], total[woff[1:]]
    behind = np.ones(len(kept), np.int64)  # the byte behind a word becomes the space, but for a text's last
    behind[end[end > begin] - 1] = 0
    edge = np.zeros(len(data) + 2, np.int32)
    np.add.at(edge, starts[kept], 1)
    np.add.at(edge, ends[kept] + behind, -1)
    mask = np.cumsum(edge)[: len(data)] > 0
    clean = data.copy()
    clean[ends[kept[behind > 0]]] = 32
    place = np.concatenate([[0], np.cumsum(mask)])
    buf = clean[mask].tobytes()
    return [buf[place[starts[kept[a]]] : place[ends[kept[b - 1]]]] if b > a else b"" for a, b in zip(begin.tolist(), end.tolist())]


def _digest(col):
    return F.unhex(F.md5(F.coalesce(col, F.lit("")).cast("binary")))


def _spread(hashes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Slots of rows that need no comparison: spread over all partitions."""
    return mix(hashes ^ mix(other + U(0x9E3779B97F4A7C15)))


def live_anchors(docs: DataFrame, window: int) -> DataFrame:
    """(name, anchors): for each text, by the 64-bit hash that names it, those of its anchors that another text holds too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.asarray(batch.column(0)).view(np.uint64)
            found, owner = [], []
            for i, _, _, _, woff, h in by_block(batch.column(1)):
                at, value = anchors(h, woff, window)
                found.append(value)
                owner.append(names[i + text_of(woff, at)])
            a, t = np.concatenate([np.zeros(0, np.uint64), *found]), np.concatenate([np.zeros(0, np.uint64), *owner])
            order = np.lexsort((t, a))
            a, t = a[order], t[order]
            new = np.ones(len(a), bool)
            new[1:] = a[1:] != a[:-1]
            fresh = new.copy()
            fresh[1:] |= t[1:] != t[:-1]
            a, t, new = a[fresh], t[fresh], new[fresh]  # one row an anchor and text
            shared = np.zeros(len(a), bool)
            shared[:-1] |= ~new[1:]
            shared |= ~new
            back = np.argsort(order[fresh])  # rows of one text side by side take less room in the shuffle
            a, t, new, shared = a[back], t[back], new[back], shared[back]
            slot = np.where(new, a, _spread(a, t))
            anchor = pa.array(a.view(np.int64), mask=new)  # as its slot
            yield pa.RecordBatch.from_arrays([pa.array(slot.view(np.int64)), pa.array(t.view(np.int64)), pa.array(shared), anchor], names=["slot", "name", "shared", "anchor"])

    rows = docs.select("name", "text").mapInArrow(run, "slot long, name long, shared boolean, anchor long")
    same = Window.partitionBy("slot")
    live = rows.withColumn("live", F.max("shared").over(same) | (F.min("name").over(same) != F.max("name").over(same))).where("live")
    return live.select("name", F.coalesce("anchor", "slot").alias("anchor")).groupBy("name").agg(F.collect_set("anchor").alias("anchors"))


def removed_windows(found: DataFrame, window: int) -> DataFrame:
    """(id, name, gone): for each text of ``found``, the windows at ``at`` that a smaller id holds too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, names = np.asarray(batch.column(0)), np.asarray(batch.column(3))
            starts = batch.column(2)
            one, two, row = [], [], []
            for i, _, _, _, woff, h in by_block(batch.column(1)):
                per = [np.asarray(starts[i + k].values) + woff[k] for k in range(len(woff) - 1)]
                at = np.concatenate([np.zeros(0, np.int64), *per]).astype(np.int64)
                one.append(hashes_at(h, at, window))
                two.append(hashes_at(h, at, window, 1))
                row.append(i + np.repeat(np.arange(len(per)), [len(p) for p in per]))
            one, two, row = (np.concatenate([np.zeros(0, kind), *x]) for x, kind in ((one, np.uint64), (two, np.uint64), (row, np.int64)))
            order = np.lexsort((row, ids[row], two, one))
            one, two, row = one[order], two[order], row[order]
            new = np.ones(len(one), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            fresh = new.copy()
            fresh[1:] |= row[1:] != row[:-1]
            one, two, row, new = one[fresh], two[fresh], row[fresh], new[fresh]
            least = ids[row[new]][np.cumsum(new) - 1] if len(one) else np.zeros(0, np.int64)
            later = ids[row] > least  # known to go; rows of the smallest id wait for other batches
            slot = np.where(later, _spread(one, ids[row].view(np.uint64) + U(1)), one)
            back = np.argsort(order[fresh])
            row, later = row[back], later[back]
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot[back].view(np.int64)), pa.array(two[back].view(np.int64)), pa.array(ids[row]), pa.array(names[row]),
                 pa.array(one[back].view(np.int64), mask=~later)], names=["slot", "two", "id", "name", "later"])

    rows = found.select("id", "text", "at", "name").mapInArrow(run, "slot long, two long, id long, name long, later long")
    same = Window.partitionBy("slot", "two")
    gone = rows.withColumn("least", F.min("id").over(same)).where("later IS NOT NULL OR id > least")
    return gone.select("id", "name", F.coalesce("later", "slot").alias("window")).groupBy("id", "name").agg(F.collect_set("window").alias("gone"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept) for each row of ``docs``.

    Words are runs without white space. A word is removed if a window over it, judged on the
    input, also occurs in a row with a smaller id. ``kept`` are the other words, joined by one
    space, or with ``with_text=False`` their SHA-256 (column ``kept_sha256``). Null texts have no
    words; texts shorter than the window keep all. A null id counts as 2^63 - 1, the largest; rows of
    one id, null ids included, never remove from each other, so repeated rows stay alike. Ids are
    integers (else an error). Other columns are ignored, and an empty table gives no rows.
    """
    if window < PERIOD + 1:
        raise ValueError(f"a window of at least {PERIOD + 1} words is needed")
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col}: integer ids are needed")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("given"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("id"),
                       text.alias("text"), F.xxhash64(text).alias("name"), _digest(text).alias("digest"))
    heads = rows.groupBy("digest", "name").agg(F.min("id").alias("head"))
    known = heads.join(live_anchors(rows, window), "name", "left").select("digest", "head", "anchors")
    last = "kept" if with_text else "kept_sha256"

    def value(words: bytes) -> str:
        return words.decode() if with_text else hashlib.sha256(words).hexdigest()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, heads_, live = np.asarray(batch.column(1)), np.asarray(batch.column(4)), batch.column(5)
            copy = ids > heads_
            n_words, n_removed, kept, at_of = [], [], [], []
            for i, data, starts, ends, woff, h in by_block(batch.column(2)):
                n = np.diff(woff)
                all_go = copy[i : i + len(n)] & (n >= window)
                where, value_at = anchors(h, woff, window)
                held = text_of(woff, where)
                begins = []
                for k in range(len(n)):
                    none = copy[i + k] or n[k] < window or not live[i + k].is_valid
                    if none:
                        begins.append(None)
                        continue
                    a, b = np.searchsorted(held, [k, k + 1])
                    hit = where[a:b][np.isin(value_at[a:b].view(np.int64), np.asarray(live[i + k].values))] - woff[k]
                    mark = np.zeros(n[k] + 1, np.int32)  # windows from PERIOD - 1 before an anchor to its own position
                    np.add.at(mark, np.maximum(hit - PERIOD + 1, 0), 1)
                    np.add.at(mark, np.minimum(hit, n[k] - window) + 1, -1)
                    begin = np.flatnonzero(np.cumsum(mark)[: n[k] - window + 1] > 0)
                    begins.append(begin.astype(np.int32) if len(begin) else None)
                texts = joined(data, starts, ends, woff, ~np.repeat(all_go, n))
                n_words += n.tolist()
                n_removed += np.where(all_go, n, 0).tolist()
                kept += [value(t) if b is None else None for t, b in zip(texts, begins)]
                at_of += begins
            open_ = pa.array([b is not None for b in at_of], pa.bool_())
            none = pa.scalar(None, batch.column(2).type)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pc.if_else(open_, batch.column(2), none), batch.column(3), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(at_of, pa.list_(pa.int32()))], names=["given", "id", "text", "name", "n_words", "n_removed", last, "at"])

    judged = cut(rows.join(known, "digest").select("given", "id", "text", "name", "head", "anchors").mapInArrow(
        judge, f"given long, id long, text string, name long, n_words long, n_removed long, {last} string, at array<int>"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at_of, gone = batch.column(2), batch.column(3)
            n_words, n_removed, kept = [], [], []
            for i, data, starts, ends, woff, h in by_block(batch.column(1)):
                n, mark = np.diff(woff), np.zeros(len(starts) + 1, np.int32)
                for k in range(len(n)):
                    if gone[i + k].is_valid:
                        at = np.asarray(at_of[i + k].values).astype(np.int64) + woff[k]
                        at = at[np.isin(hashes_at(h, at, window).view(np.int64), np.asarray(gone[i + k].values))]
                        np.add.at(mark, at, 1)
                        np.add.at(mark, at + window, -1)
                keep = np.cumsum(mark)[:-1] == 0
                total = np.concatenate([[0], np.cumsum(~keep)])
                n_words += n.tolist()
                n_removed += (total[woff[1:]] - total[woff[:-1]]).tolist()
                kept += [value(t) for t in joined(data, starts, ends, woff, keep)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", last])

    found = judged.where("at IS NOT NULL")
    ended = (found.select("given", "id", "name", "text", "at").join(removed_windows(found, window), ["id", "name"], "left").select("given", "text", "at", "gone")
             .mapInArrow(remove, f"id long, n_words long, n_removed long, {last} string"))
    done = judged.where("at IS NULL").select(F.col("given").alias("id"), "n_words", "n_removed", last)
    return done.unionByName(ended)
