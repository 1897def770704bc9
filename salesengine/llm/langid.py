"""Language identification with a string kernel.

Texts are compared by the blended-spectrum presence kernel: the number of distinct byte
n-grams (n = 1 to 3, hashed to ``DIM`` places, ASCII letters lower-cased, other ASCII as a
space) that two texts share, over the geometric mean of their own numbers. Nyström: the
kernel with a few landmark texts, whitened by the landmarks' own kernel, stands for the
text; one-versus-rest kernel ridge regression on these features gives one score a language.
At prediction the whitening and the regression are one matrix, so a block of whole texts is
scored by two matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import map_rows, no_clash
from .text import U, blocks, utf8

DIM = 8192
NGRAMS = (1, 2, 3)
UNKNOWN = "und"
#: Documented bounds of the training sample: texts and landmarks of each language.
TEXTS_PER_LANGUAGE = 400
LANDMARKS_PER_LANGUAGE = 32
MAX_LANGUAGES = 256  # more labels than that are an error
RIDGE = 1e-2
#: A text is unlike its language below this share of the likeness that all but this part of the sample reach.
LIKENESS_SHARE, LIKENESS_PART = 0.7, 0.01
CLASS = np.full(256, 32, np.uint8)
CLASS[97:123] = np.arange(97, 123)
CLASS[65:91] = np.arange(97, 123)
CLASS[128:] = np.arange(128, 256)
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    landmarks: np.ndarray  # (landmarks, DIM), each row scaled to unit length
    weights: np.ndarray  # (landmarks, languages)
    usual: np.ndarray  # (DIM, languages), share of the language's landmarks with the n-gram
    floors: np.ndarray  # (languages), the least likeness of a text in the language


def presence(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """0/1 matrix (texts x DIM) of the n-grams in each whole text; none crosses two texts."""
    out = np.zeros((len(off) - 1, DIM), np.float32)
    if not len(data):
        return out
    flat = out.ravel()
    text = np.repeat(np.arange(len(off) - 1, dtype=np.int64) * DIM, np.diff(off))
    left = np.repeat(off[1:], np.diff(off)) - np.arange(len(data))
    code = CLASS[data].astype(np.uint64)
    gram = np.zeros(len(data), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        gram = gram[: len(data) - n + 1] * U(256) + code[n - 1 :] if n > 1 else code.copy()
        if n in NGRAMS and len(gram):
            slot = ((gram + U(n << 40)) * U(0x9E3779B97F4A7C15) >> U(64 - 13)).astype(np.int64)
            ok = left[: len(gram)] >= n
            flat[(text[: len(gram)] + slot)[ok]] = 1
    return out


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each text has a letter (of any script)."""
    marks = np.concatenate([[0], np.cumsum(ASCII_LETTER[data])])
    found = marks[off[1:]] > marks[off[:-1]]
    for t in np.flatnonzero(~found & (np.diff(off) > 0)):
        found[t] = any(map(str.isalpha, data[off[t] : off[t + 1]].tobytes().decode()))
    return found


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model | None:
    """Fit on a bounded sample: about ``TEXTS_PER_LANGUAGE`` labelled texts of each language,
    those of the smallest hashes of id and text. Only their packed presence vectors reach the driver,
    and only so many: copies count once, and the rest is cut by language before.
    Rows without a label or a letter teach nothing; without any such row there is no model.

    A text's likeness to a language is the mean share of its n-grams that a landmark has, of whatever
    length the text. The sample gives each language's floor (a landmark isn't compared with itself;
    a single text gives none).
    """
    labelled = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")), F.lit(1 << 30)).alias("draw"))
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if not sizes:
        return None
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col}: more than {MAX_LANGUAGES} languages")
    cutoff = F.lit(0)
    for r in sizes:
        share = min(1.0, 1.5 * TEXTS_PER_LANGUAGE / r["count"])
        cutoff = F.when(F.col("lang") == r["lang"], F.lit(int(share * (1 << 30)))).otherwise(cutoff)

    def run(batches):
        for batch in batches:
            data, off = utf8(batch.column(0))
            for i, j in blocks(off):
                block, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
                ok = has_letter(block, o)
                bits = np.packbits(presence(block, o).astype(np.uint8), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.tobytes() for b in bits[ok]], pa.binary()), *[batch.column(c).slice(i, j - i).filter(pa.array(ok)) for c in (1, 2)]],
                    names=["bits", "lang", "draw"])

    drawn = labelled.where(F.col("draw") < cutoff).mapInArrow(run, "bits binary, lang string, draw long").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "bits"))
    got = drawn.withColumn("place", place).where(F.col("place") <= TEXTS_PER_LANGUAGE).drop("place").toPandas()
    got = got.sort_values(["lang", "draw", "bits"])
    if not len(got):
        return None
    x = np.unpackbits(np.frombuffer(b"".join(got["bits"]), np.uint8).reshape(len(got), -1), axis=1).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    langs = tuple(sorted(set(got["lang"])))
    mark = np.concatenate([np.flatnonzero(got["lang"].to_numpy() == g)[:LANDMARKS_PER_LANGUAGE] for g in langs])
    z = x[mark]
    value, vector = np.linalg.eigh(z @ z.T)
    use = value > 1e-6 * value.max()
    whiten = vector[:, use] / np.sqrt(value[use])
    features = x @ z.T @ whiten
    target = np.where(got["lang"].to_numpy()[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    balance = (1 / got.groupby("lang")["lang"].transform("size").to_numpy())[:, None]
    gram = features.T @ (features * balance)
    alpha = np.linalg.solve(gram + RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)) * 0.1, features.T @ (target * balance))
    usual, floors = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs))
    for k, g in enumerate(langs):
        own = (x[got["lang"].to_numpy() == g] > 0).astype(np.float64)
        m = min(len(own), LANDMARKS_PER_LANGUAGE)
        usual[:, k] = own[:m].mean(axis=0)
        if m > 1:
            like = own @ usual[:, k] / own.sum(axis=1)
            like[:m] = (like[:m] * m - 1) / (m - 1)
            floors[k] = LIKENESS_SHARE * np.quantile(like, LIKENESS_PART)
    return Model(langs, z.astype(np.float32), (whiten @ alpha).astype(np.float32), usual, floors)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep_from: float | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``lang_score`` (0 to 1).

    The score is half of one plus the best language's regression output, clipped. Null and
    letterless texts, and all texts where there is no model, are ``und`` with score 0. Ties go
    to the first language in order. ``keep_from``: only the rows with a language, at least that
    score and at least the language's floor of likeness, with the columns of ``docs`` alone; where there is no model
    (a corpus without labels), every row with a letter, as nothing speaks against any. Rows are judged one by one, so repeated
    rows stay; an empty table gives an empty table. A column of ``docs`` that has the name of a result is an error unless ``keep_from``.
    """
    no_clash(docs, [] if keep_from is not None else ["lang_pred", "lang_score"])
    at = docs.columns.index(text_col)
    added = [] if keep_from is not None else [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *added])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*(m.languages if m else ()), UNKNOWN], object)
        landmarks = np.ascontiguousarray(m.landmarks.T) if m else None
        for batch in batches:
            data, off = utf8(batch.column(at))
            for i, j in blocks(off, 1 << 18):
                block, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
                pick = np.full(j - i, len(names) - 1)
                best = np.zeros(j - i)
                ok = has_letter(block, o)
                if m and ok.any():
                    x = presence(block, o)
                    size = np.sqrt(np.maximum(x.sum(axis=1), 1))
                    out = (x @ landmarks / size[:, None]) @ m.weights
                    top = out.argmax(axis=1)
                    pick[ok] = top[ok]
                    if keep_from is not None:
                        like = (x @ m.usual)[np.arange(len(top)), top] / np.maximum(x.sum(axis=1), 1)
                        ok &= like >= m.floors[top]
                    best[ok] = np.clip(0.5 + 0.5 * out[np.arange(len(top)), top], 0, 1).round(4)[ok]
                rows = batch.slice(i, j - i)
                if keep_from is not None:
                    yield rows.filter(pa.array(ok & (best >= keep_from) if m else ok))
                else:
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(names[pick].tolist(), pa.string()), pa.array(best)], names=schema.names)

    return map_rows(docs, run, schema)
