"""Prefix trie of conversations, by ternary search trees over range shards.

A conversation is a path of turns, each named by a 128-bit digest of role and text. Paths are
sorted over all partitions (by path, then id), so that the conversations below any node lie side by
side, and identical ones too. A shard is a run of at most ``SHARD`` turns and conversations of a
partition: it numbers its digests in order (its dictionary) and inserts its distinct paths,
the median first, into a ternary search tree, whose sibling trees are so balanced. One iterative
traversal adds up members, leaves and savings.

A node is complete unless it lies on the path of its shard's first or last conversation: these
*boundary* nodes may go on in the neighbouring shards. They are merged in a second pass: sorted by
first turn and shard, one pass with a stack no deeper than the longest path joins equal nodes
of consecutive shards. Depth 1 is merged into the root by an ordinary aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut, shuffle_partitions

SHARD = 1 << 16
#: Key of the root among the boundary nodes.
ROOT = b""
EMPTY = hashlib.sha256().hexdigest()
NODE = "conv_id long, depth int, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_words(text):
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path array<struct(turn binary, words long)>): one row a conversation, its turns in order.

    Null turn numbers come first, turns of one number by role, then by digest of their text;
    a null role or text is empty. Rows without a conversation id are left out. A
    conversation is one row of about 24 bytes a turn, without its texts.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    name = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.struct(F.col(f"`{turn_col}`").alias("at"), role.alias("role"), name.alias("turn"), turn_words(text).alias("words")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t.turn.alias("turn"), t.words.alias("words"))).alias("path"))


def rebuilt(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first h turns taken from conversation ``c - c % every`` (h: crc32 of its id modulo ``most``)."""
    base = F.col("conv_id") - F.col("conv_id") % every
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("path", 1, most - 1).alias("head"))
    own = F.slice("path", h + 1, F.greatest(F.size("path"), F.lit(1)))
    joined = convs.withColumn("base", base).join(heads, "base", "left")
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("head", F.slice("path", 1, 0)), 1, h), own).alias("path"))


class Shard:
    """Sorted conversations of one shard: distinct paths with their members' ids, in order."""

    def __init__(self):
        self.seqs: list[tuple[bytes, ...]] = []
        self.words: dict[bytes, int] = {}
        self.ids: list[list[int]] = []
        self.size = 0

    def add(self, conv: int, path: tuple[bytes, ...], words: list[int]) -> None:
        if self.seqs and self.seqs[-1] == path:
            self.ids[-1].append(conv)
        else:
            self.seqs.append(path)
            self.ids.append([conv])
            self.words.update(zip(path, words))
            self.size += len(path)
        self.size += 1

    def tree(self) -> Tree:
        names = sorted(self.words)
        number = {name: i for i, name in enumerate(names)}
        tree = Tree(names, [self.words[n] for n in names])
        todo = [(0, len(self.seqs))]
        while todo:
            a, b = todo.pop()
            if a < b:
                mid = (a + b) // 2
                tree.insert([number[t] for t in self.seqs[mid]], mid)
                todo += [(mid + 1, b), (a, mid)]
        tree.total(self.ids)
        return tree


class Tree:
    """A ternary search tree; node 0 is the root of the trie and has no turn."""

    def __init__(self, names: list[bytes], words: list[int]):
        self.names, self.words = names, words
        self.turn, self.low, self.down, self.high, self.end = [-1], [-1], [-1], [-1], [-1]

    def _new(self, turn: int) -> int:
        for column, value in ((self.turn, turn), (self.low, -1), (self.down, -1), (self.high, -1), (self.end, -1)):
            column.append(value)
        return len(self.turn) - 1

    def find(self, node: int, turn: int) -> tuple[list[int], int, int]:
        """(links, index) at which the child ``turn`` of ``node`` hangs or would hang, and the child or -1."""
        links, i = self.down, node
        while (at := links[i]) >= 0 and self.turn[at] != turn:
            links, i = (self.low if turn < self.turn[at] else self.high), at
        return links, i, at

    def insert(self, seq: list[int], end: int) -> None:
        node = 0
        for turn in seq:
            links, i, at = self.find(node, turn)
            if at < 0:
                at = self._new(turn)
                links[i] = at
            node = at
        self.end[node] = end

    def path(self, seq: list[int]) -> list[int]:
        nodes = [0]
        for turn in seq:
            nodes.append(self.find(nodes[-1], turn)[2])
        return nodes

    def total(self, ids: list[list[int]]) -> None:
        """Parents, depths, members and smallest members of all nodes, by one traversal without recursion."""
        n = len(self.turn)
        self.parent, self.depth, self.order = [-1] * n, [0] * n, []
        todo = [0]
        while todo:
            node = todo.pop()
            self.order.append(node)
            for at in (self.high[node], self.low[node]):
                if at >= 0:
                    self.parent[at], self.depth[at] = self.parent[node], self.depth[node]
                    todo.append(at)
            if (at := self.down[node]) >= 0:
                self.parent[at], self.depth[at] = node, self.depth[node] + 1
                todo.append(at)
        self.members, self.least = [0] * n, [None] * n
        for node in reversed(self.order):
            if self.end[node] >= 0:
                own = ids[self.end[node]]
                self.members[node] += len(own)
                self.least[node] = own[0] if self.least[node] is None else min(own[0], self.least[node])
            if (up := self.parent[node]) >= 0:
                self.members[up] += self.members[node]
                self.least[up] = self.least[node] if self.least[up] is None else min(self.least[up], self.least[node])


def _ends(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def shard_rows(shard: Shard, label: tuple[int, int]) -> Iterator[dict]:
    """Complete nodes, then boundary nodes in the order of a depth-first walk.

    A complete node has its parent's ``parent_conv_id``, or the key ``up`` of a boundary parent. A
    boundary node counts complete children, leaves and savings below it only; its key is a
    digest of its whole path.
    """
    tree = shard.tree()
    number = {name: i for i, name in enumerate(tree.names)}
    first, last = (tree.path([number[t] for t in shard.seqs[i]]) for i in (0, -1))
    border = dict.fromkeys([*first, *last])
    keys = {0: ROOT}
    for node in border:
        if node:
            keys[node] = hashlib.md5(keys[tree.parent[node]] + tree.names[tree.turn[node]]).digest()
    n = len(tree.turn)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for node in reversed(tree.order):
        if node in border:
            continue
        if not children[node]:
            leaves[node] = 1
        saved[node] += (tree.members[node] - 1) * tree.words[tree.turn[node]]
        up = tree.parent[node]
        children[up] += 1
        leaves[up] += leaves[node]
        saved[up] += saved[node]
        ends = hashlib.sha256(_ends(shard.ids[tree.end[node]])).hexdigest() if tree.end[node] >= 0 else EMPTY
        yield {"conv_id": tree.least[node], "depth": tree.depth[node], "n_convs": tree.members[node], "n_children": children[node], "n_leaves": leaves[node],
               "saved_tokens": saved[node], "ends_sha256": ends, "parent_conv_id": None if up in border else tree.least[up], "up": keys.get(up)}
    early = set(first)
    for at, node in enumerate(border):
        yield {"conv_id": tree.least[node], "depth": tree.depth[node], "n_convs": tree.members[node], "n_children": children[node], "n_leaves": leaves[node],
               "saved_tokens": saved[node], "up": keys[tree.parent[node]] if node else None, "key": keys[node], "words": tree.words[tree.turn[node]] if node else 0,
               "ends": _ends(shard.ids[tree.end[node]]) if tree.end[node] >= 0 else None, "part": label[0], "shard": label[1], "at": at,
               "top": keys[(first if node in early else last)[1]] if node else ROOT}


_SHARD_ROWS = (f"{NODE}, parent_conv_id long, up binary, key binary, words long, ends binary, part int, shard int, at int, top binary")


def _batches(rows: Iterator[dict], schema: pa.Schema, many: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == many:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.strip().split() for f in ddl.split(","))])


def shards(convs: DataFrame, limit: int = SHARD) -> DataFrame:
    """The rows of ``shard_rows`` of all shards. The borders of the partitions come from Spark's sample of
    the sorted paths, about 100 a partition."""
    schema = _arrow(_SHARD_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def rows():
            shard, count = Shard(), 0
            for batch in batches:
                for conv, path, words in zip(*(c.to_pylist() for c in batch.columns)):
                    shard.add(conv, tuple(path), words)
                    if shard.size >= limit:
                        yield from shard_rows(shard, (part, count))
                        shard, count = Shard(), count + 1
            if shard.size:
                yield from shard_rows(shard, (part, count))

        yield from _batches(rows(), schema)

    flat = convs.select("conv_id", F.col("path.turn").alias("path"), F.col("path.words").alias("words"))
    spread = flat.repartitionByRange(shuffle_partitions(convs.sparkSession), "path", "conv_id").sortWithinPartitions("path", "conv_id")
    return spread.select("conv_id", "path", "words").mapInArrow(run, _SHARD_ROWS)


_MERGED = f"{NODE}, up binary, key binary"


def merged(border: DataFrame) -> DataFrame:
    """Boundary nodes made whole, but for the root, which still lacks what lies below the merged nodes of depth 1."""
    columns = ["top", "key", "up", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "ends"]
    schema = _arrow(_MERGED)

    def close(node: dict, parent: dict | None) -> dict:
        if node["depth"]:
            node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["words"]
        if parent is not None:
            parent["n_children"] += 1
            parent["n_leaves"] += node["n_leaves"]
            parent["saved_tokens"] += node["saved_tokens"]
        return {**{f: node[f] for f in schema.names if f != "ends_sha256"}, "ends_sha256": node["sha"].hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            stack: list[dict] = []  # open nodes of depth 1, 2, ... of one first turn (or the root alone)
            for batch in batches:
                for node in batch.to_pylist():
                    level = max(node["depth"] - 1, 0)
                    if len(stack) > level and stack[level]["key"] == node["key"]:
                        same = stack[level]
                        same["conv_id"] = min(same["conv_id"], node["conv_id"])
                        for f in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                            same[f] += node[f]
                    else:
                        while len(stack) > level:
                            done = stack.pop()
                            yield close(done, stack[-1] if stack else None)
                        same = {**node, "sha": hashlib.sha256(), "any": False}
                        stack.append(same)
                    if node["ends"] is not None:
                        same["sha"].update(b"," + node["ends"] if same["any"] else node["ends"])
                        same["any"] = True
            while stack:
                done = stack.pop()
                yield close(done, stack[-1] if stack else None)

        yield from _batches(rows(), schema)

    n = shuffle_partitions(border.sparkSession)
    spread = border.repartition(n, "top").sortWithinPartitions("top", "part", "shard", "at")
    return spread.select(*columns).mapInArrow(run, _MERGED)


def nodes(convs: DataFrame, limit: int = SHARD) -> DataFrame:
    """The trie's nodes over (conv_id, path) as ``paths`` gives them: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation without turns is a member of the root only. Without conversations there is no node.
    """
    rows = cut(shards(convs, limit))
    whole = cut(merged(rows.where("key IS NOT NULL")))
    top = whole.where("depth <= 1")
    below = F.col("depth") == 1
    plus = lambda c, one: F.sum(F.when(below, one).otherwise(F.col(c))).alias(c)
    total = top.agg(F.min(F.when(~below, F.col("conv_id"))).alias("conv_id"), F.lit(0).alias("depth"), F.sum(F.when(~below, F.col("n_convs"))).alias("n_convs"),
                    plus("n_children", F.lit(1)), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
                    F.max(F.when(~below, F.col("ends_sha256"))).alias("ends_sha256"), F.lit(None).cast("binary").alias("up"), F.lit(ROOT).alias("key"))
    root = total.where("conv_id IS NOT NULL").withColumn("n_leaves", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")))
    boundary = root.unionByName(whole.where("depth > 0"))
    names = boundary.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv_id"))
    columns = [f.split()[0] for f in NODE.split(", ")]
    inside = rows.where("key IS NULL")
    pending = inside.where("up IS NOT NULL").select(*columns, "up").unionByName(boundary.select(*columns, "up"))
    found = pending.join(names, "up", "left").select(*columns, F.col("up_conv_id").alias("parent_conv_id"))
    out = inside.where("up IS NULL").select(*columns, "parent_conv_id").unionByName(found)
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", *columns[2:])
