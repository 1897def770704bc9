"""CSV records that may contain line breaks, read with every split of a file in parallel.

A line break inside a quoted field looks like the end of a record to a task that sees only its own
split. So each line is summed up by what it does to the two possible states at its start, outside
and inside a quoted field (a *step*), and the work is done in two scans:

1. Each split reports the step of all its lines together: one row a split. A prefix pass over these rows
   (window functions) gives every split's state at its start.
2. Each split joins its lines to records from its now known state. What starts in one split and ends
   in another comes out as pieces, at most a few a split, which are put together by an aggregate.

Quoting is that of RFC 4180: a quote opens a field only at its start, a doubled quote stands for
one, and what follows a closing quote up to the delimiter belongs to the field. A quote within an
unquoted field is plain text. Lines end with ``\\n`` or ``\\r\\n``; inside quotes both are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_table_path

#: Steps by what becomes of (outside, inside): both stay, both change, outside after both, inside after both.
KEEP, SWAP, OUTSIDE, INSIDE = range(4)
#: A record that goes on is handed on in pieces of about this many bytes.
PIECE = 16 << 20
#: The table of splits (32 bytes a row) is broadcast up to this many rows, and joined by a shuffle beyond.
BROADCAST_SPLITS = 500_000

#: Kinds of the rows that a split gives: whole records, and the first or a further piece of one.
WHOLE, FIRST, MORE = range(3)


def _patterns(sep: str) -> tuple[str, str]:
    """(a line from outside ends inside, a line from inside ends inside)."""
    other = "[^" + "\\" + sep + "]*+"
    quoted = '[^"]*+(?:""[^"]*+)*+'
    field = f'(?:"{quoted}"{other}|[^"\\{sep}]{other}|)'
    left_open = f'(?:{field}\\{sep})*+"{quoted}\\z'
    return f"^{left_open}", f'^{quoted}(?:\\z|"{other}\\{sep}{left_open})'


def step_of(line: Column, sep: str = ",") -> Column:
    """The step of one line."""
    from_outside, from_inside = (line.rlike(p) for p in _patterns(sep))
    # a place in a table, so that each pattern is matched once
    found = F.get(F.array(*map(F.lit, (OUTSIDE, KEEP, SWAP, INSIDE))), from_outside.cast("int") * 2 + from_inside.cast("int"))
    return F.when(F.instr(line, '"') == 0, KEEP).otherwise(found).cast("tinyint")


def states(steps: np.ndarray, start: int) -> np.ndarray:
    """State (0 outside, 1 inside) before each step, and after the last."""
    at = np.arange(1, len(steps) + 1)
    fixed = np.concatenate([[0], np.maximum.accumulate(np.where(steps >= OUTSIDE, at, 0))]) if len(steps) else np.zeros(1, np.int64)
    swaps = np.concatenate([[0], np.cumsum(steps == SWAP)])
    value = np.concatenate([[start], steps == INSIDE])
    return (value[fixed] + swaps - swaps[fixed]) % 2


def runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """[i, j) of equal neighbours in all columns."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    edges = [*np.flatnonzero(new).tolist(), n]
    return list(zip(edges[:-1], edges[1:]))


def split_steps(lines: DataFrame) -> DataFrame:
    """(file, block, step): the steps of a split's lines put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.array([0, 1])

        def report():
            return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([{(0, 1): KEEP, (1, 0): SWAP, (0, 0): OUTSIDE, (1, 1): INSIDE}[tuple(total.tolist())]], pa.int8())],
                                              names=["file", "block", "step"])

        for batch in batches:
            file, block, step = (np.asarray(c) for c in batch.columns)
            for i, j in runs(file, block):
                split = (int(file[i]), int(block[i]))
                if split != now:
                    if now is not None:
                        yield report()
                    now, total = split, np.array([0, 1])
                total = np.array([states(step[i:j], s)[-1] for s in total.tolist()])
        if now is not None:
            yield report()

    return lines.select("file", "block", "step").mapInArrow(run, "file long, block long, step tinyint")


def start_states(steps: DataFrame, files: DataFrame) -> DataFrame:
    """(file, block, state, after, path, number): each split's state at its start and after its end, its file's path and
    that path's place in their order. ``steps`` has one row a split, ``files`` one a file."""
    ahead = Window.partitionBy("file").orderBy("block")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    upto = ahead.rowsBetween(Window.unboundedPreceding, 0)
    fixed, swap = F.col("step") >= OUTSIDE, (F.col("step") == SWAP).cast("int")
    counted = steps.withColumn("swaps", F.sum(swap).over(upto))
    last = F.when(fixed, F.struct((F.col("step") == INSIDE).cast("int").alias("value"), F.col("swaps").alias("swaps")))
    state = lambda w: F.coalesce(F.last(last, ignorenulls=True).over(w).value + F.sum(swap).over(w) - F.last(last, ignorenulls=True).over(w).swaps, F.sum(swap).over(w), F.lit(0)) % 2
    known = counted.select("file", "block", state(before).cast("tinyint").alias("state"), state(upto).cast("tinyint").alias("after"))
    numbers = files.withColumn("number", F.row_number().over(Window.orderBy("path")))
    return known.join(numbers, "file").select("file", "block", "state", "after", "path", "number")


class Joiner:
    """Joins the lines of one split to records, batch by batch."""

    def __init__(self, number: int, block: int, state: int):
        self.number, self.block, self.state = number, block, state
        self.line = self.pos = self.bytes = 0
        self.held: list[str] = []
        self.kind = MORE if state else FIRST
        self.out: list[pa.RecordBatch] = []

    def emit(self, pos, kind, closed, text: pa.Array) -> None:
        n = len(text)
        same = lambda v, t: pa.array(np.full(n, v, t))
        self.out.append(pa.RecordBatch.from_arrays([same(self.number, np.int32), same(self.block, np.int64), pa.array(np.asarray(pos, np.int64)), same(kind, np.int8), pa.array(np.full(n, closed)), text], names=NAMES))

    def flush(self, closed: bool) -> None:
        if self.held:
            kind = WHOLE if closed and self.kind == FIRST else self.kind
            self.emit([self.pos], kind, closed, pa.array(["\n".join(self.held)]))
            self.held, self.bytes, self.kind = [], 0, MORE

    def add(self, steps: np.ndarray, lines: pa.Array) -> None:
        state = states(steps, self.state)
        starts = np.flatnonzero(state[:-1] == 0)
        first = int(starts[0]) if len(starts) else len(lines)
        self.hold(lines[:first], closed=len(starts) > 0 or state[-1] == 0)
        if len(starts):
            end = int(starts[-1]) if state[-1] else len(lines)  # from here on the last record is open
            offsets = np.append(starts[starts < end], end).astype(np.int32)
            if len(offsets) > 1:
                whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), "\n")
                self.emit(self.line + offsets[:-1], WHOLE, True, whole)
            if state[-1]:
                self.pos, self.kind = self.line + end, FIRST
                self.hold(lines[end:], closed=False)
        self.line += len(lines)
        self.state = int(state[-1])

    def hold(self, lines: pa.Array, closed: bool) -> None:
        """More lines of the open record; ``closed`` if it ends with them."""
        if len(lines):
            if not self.held and self.kind == MORE:
                self.pos = self.line
            self.held += lines.to_pylist()
            self.bytes += lines.nbytes
        if closed:
            self.flush(True)
        elif self.bytes >= PIECE:
            self.flush(False)


NAMES = ["number", "block", "pos", "kind", "closed", "text"]
_ROWS = "number int, block long, pos long, kind tinyint, closed boolean, text string"


def _join_lines(lines: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner = None
        for batch in batches:
            number, block, state, step = (np.asarray(c) for c in batch.columns[:4])
            for i, j in runs(number, block):
                if joiner is None or (joiner.number, joiner.block) != (number[i], block[i]):
                    if joiner:
                        joiner.flush(False)
                        yield from joiner.out
                    joiner = Joiner(int(number[i]), int(block[i]), int(state[i]))
                text = batch.column(4).slice(i, j - i)
                joiner.add(step[i:j], pa.array(text.to_pylist(), pa.string()) if text.offset else text)
                yield from joiner.out
                joiner.out = []
        if joiner:
            joiner.flush(False)
            yield from joiner.out

    return lines.select("number", "block", "state", "step", "line").mapInArrow(run, _ROWS)


def _put_together(pieces: DataFrame) -> DataFrame:
    """Records of several pieces: one row each if they end, else one row a piece, marked ``open``."""
    ordered = Window.partitionBy("number").orderBy("block", "pos")
    named = pieces.withColumn("record", F.sum((F.col("kind") == FIRST).cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    named = named.withColumn("ended", F.max("closed").over(Window.partitionBy("number", "record")))
    parts = F.sort_array(F.collect_list(F.struct("block", "pos", "text")))
    whole = (named.where("ended").groupBy("number", "record").agg(parts.alias("p"))
             .select("number", F.col("p")[0].block.alias("block"), F.col("p")[0].pos.alias("pos"), F.lit(False).alias("open"), F.lit(True).alias("first"), F.array_join("p.text", "\n").alias("text")))
    left = named.where("NOT ended").select("number", "block", "pos", F.lit(True).alias("open"), (F.col("kind") == FIRST).alias("first"), "text")
    return whole.unionByName(left)


def _lines(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    raw = spark.read.text(path, lineSep="\n")
    return raw.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      step_of(F.col("value"), sep).alias("step"), F.col("value").alias("line"))


def read_records(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """(number, block, pos, open, first, text): one row a CSV record, its line breaks kept, in file order by the first three.

    ``number`` counts the files in the order of their paths, ``block`` is the first byte of the split in
    which the record starts, ``pos`` its line there; a file's header is its record 0, 0. Blank lines
    between records are none. A record whose quoted field no quote ends is ``open`` and reaches to the end of
    its file; it comes in one row a piece, of which the ``first`` stands for it.

    Only pieces are shuffled: two a split at most, beside records of more than PIECE bytes. Their files, if any, are
    scanned once more; the driver names these files, as it does when it lists the input.
    """
    lines = _lines(spark, path, sep)
    where = F.col("_metadata.file_path")
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64(where).alias("file"), where.alias("path"))
    at = new_table_path(spark, "splits")
    start_states(split_steps(lines), files).write.parquet(at)
    splits = spark.read.parquet(at)
    few = splits.count() <= BROADCAST_SPLITS
    small = lambda df: F.broadcast(df) if few else df.hint("merge")
    joined = _join_lines(lines.join(small(splits), ["file", "block"]))
    out = joined.where(F.col("kind") == WHOLE).select("number", "block", "pos", F.lit(False).alias("open"), F.lit(True).alias("first"), "text")
    cut = splits.where("state = 1 OR after = 1")
    again = [r.path for r in cut.select("path").distinct().collect()]
    if again:
        pieces = _join_lines(_lines(spark, again, sep).join(small(cut), ["file", "block"])).where(F.col("kind") != WHOLE)
        out = out.unionByName(_put_together(pieces))
    text = F.col("text")
    ended = F.when(F.endswith(text, F.lit("\r")), F.left(text, F.char_length(text) - 1)).otherwise(text)
    return out.withColumn("text", ended).where(F.col("open") | (F.trim("text") != ""))
