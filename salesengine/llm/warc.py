"""WARC archives: writing with revisit records, and reading with boundary-chain verification.

Writing: one record a row. Of rows with equal payloads, that with the smallest id is a
``response`` and the others are ``revisit`` records that refer to it and carry no payload.
Spark's text writer lays the records down, so an archive is written by many tasks at once.

Reading: tasks read byte ranges of the archives, cut at every occurrence of the magic line,
be it a record's start or bytes inside a payload. Each piece is a candidate: if a header
parses, its Content-Length names the place where the next record must start. A task follows
these links inside its own range, so that each candidate knows where its chain leaves the
range. From the start of each file, pointer jumping over the ranges' entries and exits finds
the one chain that is real; candidates off it are payload bytes and are given back to the
record that holds them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import cut

MAGIC = b"WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Broadcast bound: marks of repeated payloads, and pieces to be read again, up to so many rows.
BROADCAST_ROWS = 50_000


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's UTF-8 bytes."""
    hexed = F.sha1(text.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * g, 5), 16, 32), 4, "0") for g in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``BROADCAST_ROWS`` rows, else as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0) -> None:
    """Write one record per row of ``pages`` into archives under ``path``.

    Null payloads are empty, null uris and ids are empty headers; line breaks in uris become
    spaces. Payloads of fewer than ``min_revisit_bytes`` bytes are all responses. Rows that repeat
    the first row's id are responses as well; a payload that only rows without id have is a
    response each time. An empty table writes no record.
    """
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("order"),
                        F.translate(F.coalesce(F.col(uri_col).cast("string"), F.lit("")), "\r\n", "  ").alias("uri"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    keyed = rows.withColumn("digest", base32_sha1(F.col("payload")))
    marks = cut(keyed.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("digest").agg(F.min("order").alias("first"), F.count("*").alias("n"))
                .where("n > 1 AND first IS NOT NULL").select("digest", F.col("first").alias("first")))
    marked = keyed.join(_small(marks), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("order"))
    block = F.concat(F.lit(HTTP), F.when(revisit, "").otherwise(F.col("payload")))
    lines = [F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
             F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce("id", F.lit("")), F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.col("uri"),
             F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
             F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(""),
             F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END)]
    marked.select(F.concat(F.lit(MAGIC.decode()), *lines, block).alias("value")).write.option("lineSep", END).text(path)


def parse_header(piece: bytes) -> tuple[dict[str, str], int, int] | None:
    """(fields, header length, content length) of what follows the magic line, or None if it is no record header."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = fields.get("content-length", "")
    return (fields, end + 4, int(size)) if size.isascii() and size.isdigit() and len(size) < 16 and "warc-type" in fields else None


def payload_of(block: bytes) -> bytes:
    """The block without its HTTP header, if it has one."""
    return block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block


FIELDS = ("warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-payload-digest")
META = "file string, split long, rel long, size long, next long, exit long, whole boolean, type string, id string, refers_to string, uri string, stated_digest string, payload_bytes long, payload_digest string"


def _facts(fields: dict[str, str], payload: bytes) -> list:
    return [fields.get(f) for f in FIELDS] + [len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", MAGIC.decode()).text(path)
            .select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary")))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of each byte range, in places relative to the range's first piece."""
    schema = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[f.split()[1]]) for f in META.split(", ")])

    def close(rows):
        at = {r[2]: i for i, r in enumerate(rows) if r[4] is not None}
        for r in reversed(rows):  # links point forwards
            if r[4] is not None:
                r[5] = rows[at[r[4]]][5] if r[4] in at else r[4]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    key, rows, rel = None, [], 0
    for batch in batches:
        for file, split, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if (file, split) != key:
                if rows:
                    yield close(rows)
                key, rows, rel = (file, split), [], 0
            piece = value.as_py()
            found = parse_header(piece)
            if found:
                fields, head, size = found
                whole = head + size + len(END) == len(piece) and piece.endswith(END.encode())
                facts = _facts(fields, payload_of(piece[head : head + size])) if whole else [None] * 7
                rows.append([file, split, rel, len(piece), rel + head + size + len(END) + len(MAGIC), None, whole, *facts])
            else:
                rows.append([file, split, rel, len(piece), None, None, False, *[None] * 7])
            rel += len(piece) + len(MAGIC)
    if rows:
        yield close(rows)


def _walk(rows: pd.DataFrame) -> pd.DataFrame:
    """Marks the pieces of one byte range that start records; ``owner`` is where the holding record ends."""
    rows = rows.sort_values("at")
    place = {a: n for a, n in zip(rows["at"], rows["next"]) if n == n}
    real, at = set(), rows["entry"].iloc[0]
    while at == at and at in place:
        real.add(at)
        at = place[at]
    after = at if real else rows["later"].iloc[0]
    owner, out = after, []
    for a, n in zip(rows["at"][::-1], rows["next"][::-1]):
        out.append(n if a in real else owner)
        owner = a if a in real else owner
    return pd.DataFrame({"file": rows["file"], "split": rows["split"], "rel": rows["rel"], "at": rows["at"], "real": [a in real for a in rows["at"]], "owner": pd.array(out[::-1], "Int64")})


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per real record: file, offset, type, id, refers_to, uri, stated_digest, payload_bytes,
    payload_digest (both of the payload as read) and, if asked for, payload.

    Magic lines inside payloads start no record, also where a whole well-formed record is
    embedded. A file that doesn't begin with a record gives none. Memory of a task is bounded by
    the headers of one byte range and one piece.
    """
    found = cut(_pieces(spark, path).mapInArrow(_scan, META))
    span = found.groupBy("file", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    order = Window.partitionBy("file").orderBy("split")
    base = span.withColumn("base", F.coalesce(F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "end", F.sum("bytes").over(Window.partitionBy("file"))).select("file", "split", "base", "end")
    shift = lambda c: (F.col(c) + F.col("base")).alias(c)
    placed = cut(found.join(base, ["file", "split"]).select(
        *[c for c in found.columns if c not in ("next", "exit")], (F.col("rel") + F.col("base")).alias("at"), shift("next"), shift("exit")))

    # pointer jumping: entry of a range -> entry of the range where its chain goes on
    valid = placed.where("next IS NOT NULL")
    start = F.col("at") == len(MAGIC)
    targets = valid.select("file", F.col("exit").alias("at")).distinct()
    jump = cut(valid.select("file", "at", "exit").join(targets, ["file", "at"], "left_semi")
               .union(valid.where(start).select("file", "at", "exit")).distinct())
    reached = jump.where(start).select("file", "at")
    count = reached.count()
    while count:
        step = reached.join(jump, ["file", "at"]).select("file", F.col("exit").alias("at"))
        ahead = cut(reached.union(step.join(jump.select("file", "at"), ["file", "at"], "left_semi")).distinct())
        now = ahead.count()
        reached = ahead
        if now == count:
            break
        count = now
        twice = jump.select("file", F.col("at").alias("exit"), F.col("exit").alias("further"))
        jump = cut(jump.join(twice, ["file", "exit"], "left").select("file", "at", F.coalesce("further", "exit").alias("exit")))

    entries = placed.join(reached, ["file", "at"], "left_semi").groupBy("file", "split").agg(F.min("at").alias("entry"))
    ranges = base.join(entries, ["file", "split"], "left").withColumn(
        "later", F.coalesce(F.min("entry").over(order.rowsBetween(1, Window.unboundedFollowing)), F.col("end"))).select("file", "split", "entry", "later")
    walked = cut(placed.join(ranges, ["file", "split"]).select("file", "split", "rel", "at", "next", "entry", "later")
                 .groupBy("file", "split").applyInPandas(_walk, "file string, split long, rel long, at long, real boolean, owner long"))
    place = ["file", "split", "rel"]
    real = placed.join(walked.where("real").select(*place, "owner"), place)
    facts = ["type", "id", "refers_to", "uri", "stated_digest", "payload_bytes", "payload_digest"]
    simple = real.where("whole").select("file", (F.col("at") - len(MAGIC)).alias("offset"), *facts, *place[1:])
    broken = cut(real.where("NOT whole").select("file", F.col("at").alias("start"), "owner"))
    parts = None
    if broken.limit(1).count():
        parts = cut(walked.join(broken, ["file", "owner"]).select(*place, "at", "start"))
    records = [simple.select("file", "offset", *facts)]
    if with_payload:
        body = _again(spark, path, simple.select(*place, F.col("offset")))
        out = "file string, offset long, payload binary"

        def strip(batches):
            for b in batches:
                values = [payload_of(v[h[1] : h[1] + h[2]]) for v in b.column(2).to_pylist() for h in [parse_header(v)]]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(values, pa.binary())], names=["file", "offset", "payload"])

        payloads = body.select("file", "offset", "value").mapInArrow(strip, out)
        records = [simple.select("file", "offset", *facts).join(payloads, ["file", "offset"])]
    if parts is not None:
        columns = "file string, offset long, type string, id string, refers_to string, uri string, stated_digest string, payload_bytes long, payload_digest string" + ", payload binary" * with_payload

        def whole(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("at")
            data = MAGIC.join(rows["value"])
            fields, head, size = parse_header(data)
            payload = payload_of(data[head : head + size])
            row = [rows["file"].iloc[0], rows["start"].iloc[0] - len(MAGIC), *_facts(fields, payload)] + [payload] * with_payload
            return pd.DataFrame([row], columns=[c.split()[0] for c in columns.split(", ")])

        records.append(_again(spark, path, parts).groupBy("file", "start").applyInPandas(whole, columns))
    out = records[0]
    for more in records[1:]:
        out = out.unionByName(more)
    return out


def _again(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The named pieces (file, split, rel and more columns) with their bytes."""

    def run(batches):
        key, rel = None, 0
        for b in batches:
            places = []
            for file, split, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if (file, split) != key:
                    key, rel = (file, split), 0
                places.append(rel)
                rel += len(size.as_py()) + len(MAGIC)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(places, pa.int64()), b.column(2)], names=["file", "split", "rel", "value"])

    again = _pieces(spark, path).mapInArrow(run, "file string, split long, rel long, value binary")
    return again.join(_small(wanted), ["file", "split", "rel"])
