"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from the whole text alone.  The trees are grown on the driver from a bounded
sample of labelled rows, flattened into arrays, and walked by numpy inside the tasks, all trees of a
batch at once.

Sample bound: at most ``MAX_PER_CLASS`` labelled rows of each class, those with the smallest hash of
their id, weighted back to the class sizes.  A row without a label or with a null one is not used;
of repeated labels of one id the largest counts.  If one class is missing, every score is the share
of the other class; if there are no labels, 0.5.  A null text is an empty one and gets a score as any
other; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import id_and_text, unused

MAX_PER_CLASS = 10_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
LEAST_HESSIAN = 2.0
RIDGE = 1.0
ACCEPT = 0.7
HOLD_OUT = (4, 2)

_KINDS = {"symbol": b"#*$%&|<>{}[]\\^~_@+=/", "pipe": b"|", "bang": b"!?", "stop": b".,;:", "digit": b"0123456789",
          "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "line": b"\n"}
FEATURES = ["log_words", "word_bytes", "longest_word", "new_words", "new_pairs", "top_word", "dup_lines",
            "words_a_line", "marked_words", *_KINDS]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    raw = texts.cast(pa.binary())
    out = np.zeros((len(raw), len(FEATURES)))
    kinds = [np.frombuffer(v, np.uint8) for v in _KINDS.values()]
    for i, item in enumerate(raw):
        text = item.as_buffer().to_pybytes() if item.is_valid else b""
        words = text.split()
        n = len(words)
        if not n:
            continue
        lines = [x for x in text.split(b"\n") if x.strip()]
        seen = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
        counts = np.bincount(seen)
        pairs = len(np.unique(seen[1:] * n + seen[:-1]))
        sizes = np.fromiter(map(len, words), np.int64, n)
        last = np.fromiter((w[-1] for w in words), np.uint8, n)
        marked = np.isin(last, kinds[0]).sum()
        histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        total = sizes.sum()
        out[i] = [np.log1p(n), total / n, np.log1p(sizes.max()), len(counts) / n, (pairs + 1) / n, counts.max() / n,
                  1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), marked / n,
                  *(histogram[k].sum() / total for k in kinds)]
    return out


@dataclass(frozen=True)
class Forest:
    """Complete trees as arrays: ``feature`` and ``cut`` by inner node, ``value`` by leaf; a row goes right above the cut."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        margin = np.full(len(rows), self.base)
        trees = np.arange(len(self.feature))
        for at in range(0, len(rows), 4096):
            part = rows[at:at + 4096]
            node = np.zeros((len(part), len(trees)), np.int64)
            if len(trees):
                which = np.arange(len(part))[:, None]
                for _ in range(DEPTH):
                    right = part[which, self.feature[trees, node]] > self.cut[trees, node]
                    node = 2 * node + 1 + right
                margin[at:at + 4096] += self.value[trees, node - (2 ** DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def _grow(bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray):
    """One tree over binned rows: its node arrays and the leaf of every row."""
    n, width = bins.shape
    feature, cut = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf)
    node = np.zeros(n, np.int64)
    for level in range(DEPTH):
        first, many = 2 ** level - 1, 2 ** level
        cell = ((node - first)[:, None] * width + np.arange(width)) * BINS + bins
        size = many * width * BINS
        g = np.bincount(cell.ravel(), np.repeat(grad, width), size).reshape(many, width, BINS).cumsum(axis=2)
        h = np.bincount(cell.ravel(), np.repeat(hess, width), size).reshape(many, width, BINS).cumsum(axis=2)
        g_all, h_all = g[:, :, -1:], h[:, :, -1:]
        gain = g ** 2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all ** 2 / (h_all + RIDGE)
        gain[(h < LEAST_HESSIAN) | (h_all - h < LEAST_HESSIAN)] = 0
        flat = gain.reshape(many, -1)
        best = flat.argmax(axis=1)
        split = flat[np.arange(many), best] > 1e-6
        f, b = best // BINS, best % BINS
        for k in np.flatnonzero(split):
            feature[first + k], cut[first + k] = f[k], cuts[f[k]][b[k]]
        own = node - first
        right = split[own] & (bins[np.arange(n), f[own]] > b[own])
        node = 2 * node + 1 + right
    return feature, cut, node - (2 ** DEPTH - 1)


def grow_forest(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Forest:
    """Logistic boosting with second-order leaf values."""
    share = float((labels * weights).sum() / weights.sum()) if len(labels) else 0.5
    base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    none = np.zeros((0, 2 ** DEPTH - 1))
    if len(np.unique(labels)) < 2:
        return Forest(base, none.astype(np.int64), none, np.zeros((0, 2 ** DEPTH)))
    # A cut closes its bin; the last bin has none, as nothing lies above it.
    cuts = [np.append(np.unique(np.quantile(c, np.arange(1, BINS) / BINS, method="lower")), np.inf) for c in rows.T]
    bins = np.stack([np.searchsorted(q, c, side="left") for q, c in zip(cuts, rows.T)], axis=1)
    cuts = [np.pad(q, (0, BINS - len(q)), constant_values=np.inf) for q in cuts]
    margin = np.full(len(rows), base)
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weights * (p - labels), weights * p * (1 - p)
        feature, cut, leaf = _grow(bins, cuts, grad, hess)
        value = -RATE * np.bincount(leaf, grad, 2 ** DEPTH) / (np.bincount(leaf, hess, 2 ** DEPTH) + RIDGE)
        margin += value[leaf]
        trees.append((feature, cut, value))
    return Forest(base, *(np.stack(x) for x in zip(*trees)))


def held_out(doc_id: Column) -> Column:
    """Whether an id belongs to the held-out rows; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT[0] == HOLD_OUT[1], F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> Forest:
    """Grow the forest from labelled rows that are not held out."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class) for q in (0, 1)]
    rows = id_and_text(docs).join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").select(
        "quality", F.arrow_udf(lambda t: pa.array(list(statistics(t)), pa.list_(pa.float64())), T.ArrayType(T.DoubleType()))("text").alias("x")).collect()
    x = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES))
    y = np.array([r["quality"] for r in rows], np.float64)
    weight = np.array([sizes[r["quality"]] / max(1, min(sizes[r["quality"]], max_per_class)) for r in rows], np.float64)
    return grow_forest(x, y, weight / weight.mean() if len(weight) else weight)


def score(text: Column, forest: Forest) -> Column:
    """Score of a text column, 0 to 1; null counts as the empty text."""
    @F.arrow_udf(T.DoubleType())
    def udf(texts: pa.Array) -> pa.Array:
        return pa.array(forest.score(statistics(pc.fill_null(texts, ""))))

    return udf(text)


def classify(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    forest = fit(docs, labels)
    rows = id_and_text(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), forest).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= accept).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The documents, with all their columns, that the classifier accepts."""
    name = unused(docs, "quality_score")
    return docs.withColumn(name, score(F.col("text"), fit(docs, labels))).filter(F.col(name) >= accept).drop(name)
