"""Quality filter by weak supervision.

Each rule looks at one measured property of a text and votes good (+1), bad (-1) or
abstains (0) between its two thresholds. No rule decides alone: expectation-maximisation
over the counts of all vote patterns in the corpus estimates, for the hidden classes (good,
and the kinds of bad texts), how often each rule votes each way, and a text is kept when its posterior probability of
being good is at least one half. The patterns number at most 3 ** len(RULES), whatever the
corpus, so their counts are the only thing that reaches the driver.

Independent of the votes, texts of fewer than 20 words and texts with over 30 % of their
words inside repeated 8-word windows fail outright (``base_failed``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .tables import map_rows, no_clash
from .text import SPACE, blocks, span_hashes, sums_by, utf8, windows, word_spans

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: The characters that count as symbols.
SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1
UPPER = np.zeros(256, np.int64)
UPPER[65:91] = 1
LETTER = UPPER.copy()
LETTER[97:123] = 1
DIGIT = np.zeros(256, np.int64)
DIGIT[48:58] = 1
WORDED = LETTER | DIGIT  # what makes a word more than symbols; bytes above 0x7F count as letters
WORDED[128:] = 1

#: name -> (good up to, bad from); "low is good" if the first is smaller, else "high is good".
RULES = {
    "symbols_per_word": (0.01, 0.1),
    "repeated_share": (0.15, 0.29),
    "dup_line_share": (0.34, 0.5),
    "word_length_off": (1.5, 3.0),
    "upper_share": (0.15, 0.4),
    "bangs_per_word": (0.05, 0.2),
    "digit_share": (0.1, 0.3),
    "distinct_share": (0.45, 0.3),
    "short_word_share": (0.1, 0.03),
    "lone_symbol_share": (0.05, 0.2),
    "echo_share": (0.03, 0.1),
}
#: Hidden kinds of bad texts, each by the rules that speak of it; they only start the estimation.
KINDS = {
    "junk": ("symbols_per_word", "word_length_off", "upper_share", "bangs_per_word", "digit_share", "short_word_share", "lone_symbol_share"),
    "repetition": ("repeated_share", "dup_line_share", "distinct_share", "echo_share"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(data: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The five measures of each text of a block, and the votes of every rule (texts x rules)."""
    starts, ends, woff = word_spans(data, off)
    n = np.diff(woff)
    safe = np.maximum(n, 1)
    chars = (data & 0xC0) != 0x80
    total = lambda flags: sums_by(flags, off)
    word_chars = total(chars & ~SPACE[data])
    hashes = span_hashes(data, starts, ends)

    # words inside windows that occur twice or more
    win, first, soff = windows(hashes, woff, WINDOW, short=False)
    text_of = np.repeat(np.arange(len(n)), np.diff(soff))
    order = np.lexsort((win, text_of))
    same = (win[order][1:] == win[order][:-1]) & (text_of[order][1:] == text_of[order][:-1])
    twice = np.zeros(len(win), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, first[twice], 1)
    np.add.at(edge, first[twice] + WINDOW, -1)
    n_repeat = sums_by(np.cumsum(edge)[:-1] > 0, woff)

    distinct = np.zeros(len(n), np.int64)
    dup_lines = np.zeros(len(n), np.int64)
    lines = np.ones(len(n), np.int64)
    newline = np.flatnonzero(data == 10)
    for t in range(len(n)):
        a, b = woff[t], woff[t + 1]
        if b > a:
            distinct[t] = len(set(hashes[a:b].tolist()))
    noff = np.searchsorted(newline, off)
    for t in np.flatnonzero(np.diff(noff)):
        text = data[off[t] : off[t + 1]].tobytes()
        worded = Counter(line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r"))
        lines[t] = max(1, worded.total())
        dup_lines[t] = worded.total() - len(worded)

    worded_before = np.concatenate([[0], np.cumsum(WORDED[data])])
    short = (ends - starts <= 3) & (worded_before[ends] > worded_before[starts])
    echo = np.zeros(len(hashes), bool)
    echo[1:] = hashes[1:] == hashes[:-1]
    echo[woff[:-1][n > 0]] = False
    letters = total(LETTER[data])
    mean = word_chars / safe
    values = {
        "symbols_per_word": total(SYMBOLS[data]) / safe,
        "repeated_share": n_repeat / safe,
        "dup_line_share": dup_lines / lines,
        "word_length_off": np.abs(mean - 5.5),
        "upper_share": total(UPPER[data]) / np.maximum(letters, 1),
        "bangs_per_word": total(data == 33) / safe,
        "digit_share": total(DIGIT[data]) / np.maximum(word_chars, 1),
        "distinct_share": distinct / safe ** 0.5 / np.minimum(safe, 400) ** 0.5,
        "short_word_share": sums_by(short, woff) / safe,
        "lone_symbol_share": sums_by(worded_before[ends] == worded_before[starts], woff) / safe,
        "echo_share": sums_by(echo, woff) / safe,
    }
    votes = np.zeros((len(n), len(RULES)), np.int8)
    for r, (name, (good, bad)) in enumerate(RULES.items()):
        sign = 1 if good < bad else -1
        votes[:, r] = np.where(sign * values[name] <= sign * good, 1, np.where(sign * values[name] >= sign * bad, -1, 0))
    votes[n == 0] = 0
    return dict(zip(MEASURES, (n, word_chars, total(SYMBOLS[data]), dup_lines, n_repeat))), votes


def base_failed(m: dict[str, np.ndarray]) -> np.ndarray:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def pattern_code(votes: np.ndarray) -> np.ndarray:
    return (votes.astype(np.int64) + 1) @ 3 ** np.arange(votes.shape[1])


def _measured(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, dict, np.ndarray]]:
    for batch in batches:
        data, off = utf8(batch.column(at))
        for i, j in blocks(off):
            m, votes = measure(data[off[i] : off[j]], off[i : j + 1] - off[i])
            yield batch.slice(i, j - i), m, pattern_code(votes)


def em(codes: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 1.0) -> np.ndarray:
    """Posterior probability of good for every code 0 .. 3 ** rules - 1.

    Hidden classes: good, and the kinds of bad texts. Each rule's three outcomes are
    independent given the class, with ``smooth`` pseudo-counts. The start gives patterns with
    two bad votes, or with more bad than good ones, to the kind with most of them; it ends
    when nothing moves by 1e-9. Without patterns the start decides.
    """
    rules = list(RULES)
    members = np.array([[name in kind for name in rules] for kind in KINDS.values()]).T

    def outcomes(code):
        return code[:, None] // 3 ** np.arange(len(rules)) % 3

    def start(votes):
        bad = votes == 0
        doubtful = (bad.sum(1) >= 2) | (bad.sum(1) > (votes == 2).sum(1))
        out = np.full((1 + len(KINDS), len(votes)), 0.1 / len(KINDS))
        out[np.where(doubtful, 1 + (bad @ members.astype(int)).argmax(1), 0), np.arange(len(votes))] = 0.9
        return out / out.sum(0)

    def posterior(votes, prior, tables):
        log = np.log(prior)[:, None] + sum(np.log(tables[:, r])[:, votes[:, r]] for r in range(len(rules)))
        share = np.exp(log - log.max(0))
        return share / share.sum(0)

    every = outcomes(np.arange(3 ** len(rules)))
    if not len(codes):
        return start(every)[0]
    votes = outcomes(codes)
    post = start(votes)
    for _ in range(rounds):
        mass = counts * post
        prior = (mass.sum(1) + smooth) / (counts.sum() + len(mass) * smooth)
        tables = np.array([[np.bincount(votes[:, r], m, 3) + smooth for r in range(len(rules))] for m in mass])
        tables /= tables.sum(2, keepdims=True)
        was, post = post, posterior(votes, prior, tables)
        if np.abs(post - was).max() < 1e-9:
            break
    return posterior(every, prior, tables)[0]


def fit(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Posterior table by vote pattern, estimated from every text of ``docs``."""

    def run(batches):
        total: Counter = Counter()
        for _, m, codes in _measured(batches, 0):
            total.update(codes[~base_failed(m)].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["code", "n"])

    rows = docs.select(docs[text_col].cast("string")).mapInArrow(run, "code long, n long").groupBy("code").sum("n").collect()
    return em(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float))


def score(docs: DataFrame, posterior: np.ndarray, text_col: str = "text", threshold: float = 0.5, keep_only: bool = False) -> DataFrame:
    """All columns of ``docs`` plus the measures, ``base_failed``, ``quality`` and ``kept``.

    ``keep_only``: just the kept rows, with the columns of ``docs`` alone. Null and empty
    texts have no words: they fail the base rule. Repeated rows are judged one by one;
    an empty table gives an empty table. A column of ``docs`` that has the name of a result
    is an error unless ``keep_only``.
    """
    no_clash(docs, [] if keep_only else [*MEASURES, "base_failed", "quality", "kept"])
    at = docs.columns.index(text_col)
    added = [] if keep_only else [*[T.StructField(c, T.LongType()) for c in MEASURES], T.StructField("base_failed", T.BooleanType()), T.StructField("quality", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches):
        for rows, m, codes in _measured(batches, at):
            failed = base_failed(m)
            quality = posterior[codes]
            kept = ~failed & (quality >= threshold)
            if keep_only:
                yield rows.filter(pa.array(kept))
            else:
                extra = [pa.array(m[c]) for c in MEASURES] + [pa.array(failed), pa.array(quality), pa.array(kept)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *extra], names=schema.names)

    return map_rows(docs, run, schema)
