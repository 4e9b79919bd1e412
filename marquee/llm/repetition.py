"""Quality rules on repetition, from the suffix array of every document's words.

The suffix array of a batch of documents is built by prefix doubling over whole arrays; only
suffixes that still share their prefix with another one are sorted again.  The ranks after every
doubling give the longest common prefix of neighbours in the array.  The larger of a suffix's two
prefixes is the longest repeat that starts there, so the union of these spans is the union of all
maximal repeated substrings.  A document passes if the covered share of its words and its longest
repeat stay within limits.

Texts are read whole.  A null text is an empty one: no words, every count 0, and it fails the base
rule on length.  Rows are judged one by one, so repeated rows and ties get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import BLANKS, id_and_text, slices

# Base rules: least words, and most words in repeated windows of three words, of a hundred.
LEAST_WORDS = 50
WINDOW_WORDS = 3
MOST_REPEATED = 50
# Rules of the method, in words: a repeat counts from MIN_REPEAT words on.
MIN_REPEAT = 5
MOST_COVERED = 0.40
LONGEST_REPEAT = 100
SYMBOLS = b"#*$%&|<>"
# Bytes of text worked on at once; a longer document is worked on alone.
BATCH_BYTES = 4 << 20

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, n_covered bigint, longest_repeat bigint")


def longest_repeats(tokens: np.ndarray) -> np.ndarray:
    """For every position of an integer sequence, the length of the longest repeat that starts there."""
    n = len(tokens)
    if n < 2:
        return np.zeros(n, np.int64)
    order = np.argsort(tokens, kind="stable")
    new = np.ones(n, bool)
    new[1:] = tokens[order[1:]] != tokens[order[:-1]]
    rank = np.empty(n, np.int64)
    # A rank is the first place in the array of all suffixes with that prefix.
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, width = [], 1
    while True:
        levels.append(rank)
        active = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(active):
            break
        follow = np.where(active + width < n, rank[np.minimum(active + width, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        head = rank[active]
        new = np.ones(len(active), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.ones(len(active), bool)
        first[1:] = head[1:] != head[:-1]
        at = np.arange(len(active))
        within = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(first, at, 0))
        rank = rank.copy()
        rank[active] = head + within
        width *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    near = np.flatnonzero(levels[0][array[1:]] == levels[0][array[:-1]])
    a, b = array[near], array[near + 1]
    shared = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = np.maximum(x, y) < n
        same = inside & (levels[k][np.where(inside, x, 0)] == levels[k][np.where(inside, y, 0)])
        shared += same.astype(np.int64) << k
    best = np.zeros(n, np.int64)
    best[a] = shared
    best[b] = np.maximum(best[b], shared)
    return best


def _covered(best: np.ndarray, least: int, width: int | None, starts: np.ndarray) -> np.ndarray:
    """Words per document inside a repeat of ``least`` words or more (or inside windows of ``width``)."""
    n = len(best)
    at = np.flatnonzero(best >= least)
    ends = at + (best[at] if width is None else width)
    change = np.bincount(at, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(change[:n]) > 0)))
    return np.diff(inside[starts])


def _measure(texts: list[str]) -> list[np.ndarray]:
    raw = [t.encode() for t in texts]
    words = [r.split() for r in raw]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    flat = pa.array([w for ws in words for w in ws], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    # Words of different documents never compare equal, so no repeat crosses a document's end.
    owner = np.repeat(np.arange(len(texts)), sizes)
    best = longest_repeats(owner << 32 | codes)
    lines = [[x for x in r.split(b"\n") if x.strip()] for r in raw]
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, owner, best)
    return [
        sizes,
        np.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], np.int64),
        np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raw], np.int64),
        np.array([len(x) - len(set(x)) for x in lines], np.int64),
        _covered(best, WINDOW_WORDS, WINDOW_WORDS, starts),
        _covered(best, MIN_REPEAT, None, starts),
        np.where(top >= MIN_REPEAT, top, 0),
    ]


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).to_numpy()
        for a, b in slices(sizes, BATCH_BYTES):
            part = batch.slice(a, b - a)
            columns = _measure(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, columns)], names=[f.split()[0] for f in SCHEMA.split(", ")])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts per document; ``n_covered`` words lie in repeats, the longest has ``longest_repeat``."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_measure_batches, SCHEMA)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_covered: float = MOST_COVERED,
          longest: int = LONGEST_REPEAT) -> DataFrame:
    """The counts with ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    fine = (F.col("n_covered") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    return measure(docs, id_col, text_col).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)
