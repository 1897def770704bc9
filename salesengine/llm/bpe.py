"""Byte-pair encoding and decoding with a vocabulary file.

Reads the tokenizer file's vocabulary, merge ranks, added tokens and pre-tokenisation
pattern. A word's symbols form a doubly linked list; a priority queue holds the merge rank
and place of each adjacent pair. The lowest rank is merged first (ties: leftmost); entries
whose pair has changed meanwhile are skipped as stale. Decoding looks the ids up in the
vocabulary and concatenates the strings, one space between, which is what the file asks for
(it names no decoder).

The file is read on the driver and broadcast. Encoded words are kept in a bounded table in
each worker; it is emptied when full, so memory doesn't grow with the input.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 600_000
#: Fixed value: Unicode white space.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class BPE(dict):
    """Maps a pre-token to its ids, as decimal text with spaces; see ``encode`` and ``decode``."""

    def __init__(self, spec: str):
        super().__init__()
        self.spec = spec
        raw = json.loads(spec)
        model = raw["model"]
        for key in ("dropout", "unk_token", "continuing_subword_prefix"):
            if model.get(key):
                raise ValueError(f"unsupported: {key}")
        steps = [n["type"] for n in raw["normalizer"]["normalizers"]]
        split, byte_level = raw["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or byte_level["type"] != "ByteLevel" or not split["invert"]:
            raise ValueError("unsupported normaliser or pre-tokeniser")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in raw["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", WHITE))
        symbols = byte_symbols()
        self.inner = [vocab[c] for c in symbols]
        self.final = [vocab[c + suffix] for c in symbols]
        self.merges = {vocab[a] << 20 | vocab[b]: rank << 20 | vocab[a + b] for rank, (a, b) in enumerate(model["merges"])}
        self.strings = {str(i): s for s, i in (vocab | self.added).items()}

    def __reduce__(self):
        return BPE, (self.spec,)

    def word(self, token: str) -> list[int]:
        """Ids of one pre-token."""
        data = token.encode()
        ids = [self.inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        n = len(ids)
        if n == 1:
            return ids
        merges = self.merges
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        # entries are (rank, place, merged id) in one integer
        queue = [(m >> 20) << 64 | i << 20 | m & 0xFFFFF for i in range(n - 1) if (m := merges.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            top = heapq.heappop(queue)
            i, new = top >> 20 & 0xFFFFFFFFFFF, top & 0xFFFFF
            j = right[i]
            if ids[i] < 0 or j >= n or merges.get(ids[i] << 20 | ids[j]) != (top >> 64) << 20 | new:
                continue
            ids[i], ids[j] = new, -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (m := merges.get(new << 20 | ids[k])) is not None:
                    heapq.heappush(queue, (m >> 20) << 64 | i << 20 | m & 0xFFFFF)
            h = left[i]
            if h >= 0 and (m := merges.get(ids[h] << 20 | new)) is not None:
                heapq.heappush(queue, (m >> 20) << 64 | h << 20 | m & 0xFFFFF)
        return [i for i in ids if i >= 0]

    def __missing__(self, token: str) -> str:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = " ".join(map(str, self.word(token)))
        if len(token) <= 64:
            self[token] = out
        return out

    def plain(self, text: str) -> list[str]:
        """Encoded pre-tokens of text without added tokens."""
        if not text.isascii():
            # lower-casing goes character by character: a final sigma is like any other
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return list(map(self.__getitem__, self.words.findall(text.lower())))

    def encode(self, text: str) -> str:
        """Ids of a whole text as decimal text with spaces."""
        if self.special is None or "<" not in text:
            return " ".join(self.plain(text))
        out: list[str] = []
        for part in self.special.split(text):
            out += [str(self.added[part])] if part in self.added else self.plain(part)
        return " ".join(out)

    def decode(self, ids: str) -> str:
        return " ".join(map(self.strings.__getitem__, ids.split(" "))) if ids else ""


def load(path: str) -> BPE:
    with open(path, encoding="utf-8") as f:
        return BPE(f.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every whole text.

    The digests are of the decimal ids joined by one space and of the decoded text. Null and
    empty texts have no tokens (digests of the empty string). Repeated rows stay; an empty
    table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                n, ids_sha, text_sha, ids = [], [], [], []
                for text in rows.column(1):
                    line = bpe.encode(text.as_py() or "")
                    n.append(line.count(" ") + 1 if line else 0)
                    ids_sha.append(digest(line))
                    text_sha.append(digest(bpe.decode(line)))
                    if with_ids:
                        ids.append([int(i) for i in line.split()])
                columns = [rows.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names=names + ["ids"] * with_ids)

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)
