"""SimHash near-duplicates by a generalised pigeonhole search.

Fingerprints within ``threshold`` bits must agree, in at least one part of a split of the 64 bits, up
to that part's own threshold, as long as the parts' thresholds plus one add up to ``threshold + 1``.
Bits that move together share a part; the parts and their thresholds are chosen by dynamic
programming over the cost expected from the bit statistics of all fingerprints.  Every distinct
fingerprint then visits the buckets within each part's threshold, and pairs that meet are verified.

A bucket never emits its pairs: what links inside a bucket leaves it as a forest, so a cluster of k
fingerprints costs k rows.  A bucket too large for one task is dealt out in blocks; after the blocks
are linked, only fingerprints outside the bucket's main component are compared across blocks.

Equal fingerprints are one fingerprint from the start.  A null text is empty, a null id never is the
smallest of a component with other ids, repeated rows stay repeated, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import id_and_text, join_groups, stage_rows, unused
from marquee.operators.components import connected_components, stars
from marquee.operators.ranking import top_per_group

BITS = 64
SHINGLE_WORDS = 4
SEED = 42
THRESHOLD = 4
# Most rows of a bucket in one task.
BLOCK = 1 << 14
# Costs, in verified pairs: a row sent to a bucket.
ROW_COST = 50.0
_SLICE = 1 << 16


def _fingerprint(text: bytes, n: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = min(n, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - n + 1].tolist()
    ends = ends[n - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _SLICE):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at:at + _SLICE], ends[at:at + _SLICE])], np.uint64)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprint(text, words: int = SHINGLE_WORDS):
    """Fingerprint of a text column as a long with the bits of the unsigned value; null is the empty text."""
    @F.arrow_udf(T.LongType())
    def udf(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary())
        values = np.fromiter((_fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", words) for x in raw),
                             np.uint64, len(raw))
        return pa.array(values.view(np.int64))

    return udf(text)


@dataclass(frozen=True)
class Part:
    """A set of bits and the number of them in which a visited bucket may differ."""

    bits: tuple[int, ...]
    threshold: int

    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    def flips(self) -> list[tuple[int, int]]:
        """``(bits to flip, highest of them)`` of every visit; no flip is the own bucket.

        Of two fingerprints only the one whose highest differing bit is 0 visits the other.
        """
        out = [(0, 0)]
        for k in range(1, self.threshold + 1):
            out += [(sum(1 << b for b in c), 1 << max(c)) for c in combinations(self.bits, k)]
        return out


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def bit_statistics(reps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for every two bits, how many have both set."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(fps, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        at = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["at", "n"])

    sums = reps.select("fp").mapInArrow(gram, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for row in sums:
        flat[row["at"]] = row["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def _group_bits(both: np.ndarray, n: int, parts: int) -> list[tuple[int, ...]]:
    """Split the bits into parts of near-equal width, each grown by the bit that moves most with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        width = (BITS * (k + 1)) // parts - (BITS * k) // parts
        left = sorted(free)
        members = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        free.discard(members[0])
        while len(members) < width:
            left = sorted(free)
            members.append(left[int(np.argmax(corr[np.ix_(left, members)].sum(axis=1)))])
            free.discard(members[-1])
        out.append(tuple(sorted(members)))
    return out


def plan_parts(n: int, both: np.ndarray, threshold: int = THRESHOLD) -> list[Part]:
    """Parts and thresholds of least expected cost; any plan finds all links, only its cost differs."""
    n = max(n, 2)
    p = np.diag(both) / max(n, 1)
    differ = np.clip(2 * p * (1 - p), 1e-3, 0.5)
    best, chosen = np.inf, []
    for m in range(1, threshold + 2):
        groups = _group_bits(both, n, m)
        costs = []
        for bits in groups:
            near = np.zeros(threshold + 1)
            near[0] = 1.0
            for b in bits:
                near[1:], near[0] = near[1:] * (1 - differ[b]) + near[:-1] * differ[b], near[0] * (1 - differ[b])
            within, rows = np.cumsum(near), np.cumsum([1.0] + [comb(len(bits), k) / 2 for k in range(1, threshold + 1)])
            # Units of a part: its threshold plus one; a part without a unit is not searched.
            costs.append([0.0] + [ROW_COST * n * rows[t] + n * n / 2 * within[t] for t in range(threshold + 1)])
        table = [(0.0, ())] + [(np.inf, ())] * (threshold + 1)
        for cost in costs:
            table = [min(((table[u - k][0] + cost[k], table[u - k][1] + (k,)) for k in range(min(u, len(cost) - 1) + 1)),
                         key=lambda x: x[0]) for u in range(threshold + 2)]
        total, units = table[threshold + 1]
        if total < best:
            best, chosen = total, [Part(bits, k - 1) for bits, k in zip(groups, units) if k]
    return chosen


def _search(fps: np.ndarray, threshold: int) -> tuple[list, list]:
    """Links of one large bucket by breadth-first search: found fingerprints are not compared again."""
    left, a, b = fps, [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            one, front = front[0], front[1:]
            near = np.bitwise_count(left ^ one) <= threshold
            if near.any():
                found = left[near]
                a.append(np.full(len(found), one))
                b.append(found)
                front, left = np.concatenate((front, found)), left[~near]
    return a, b


def _link_sorted(threshold: int, small: int = 256, rows_at_once: int = 200_000):
    """Arrow function over rows sorted by bucket: ``bucket columns..., fp`` to links ``src, dst``."""
    def links(table: pa.Table, n_keys: int):
        keys = [table.column(i).to_numpy() for i in range(n_keys)]
        fps = table.column(n_keys).to_numpy().view(np.uint64)
        new = np.ones(len(fps), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(fps)))
        group_end = np.repeat(starts + sizes, sizes)
        is_small = np.repeat(sizes <= small, sizes)
        a, b = [], []
        at = np.flatnonzero(is_small)
        step = 1
        while len(at):
            at = at[at + step < group_end[at]]
            x, y = fps[at], fps[at + step]
            near = (np.bitwise_count(x ^ y) <= threshold) & (x != y)
            a.append(x[near])
            b.append(y[near])
            step += 1
        for s, z in zip(starts[sizes > small], sizes[sizes > small]):
            found = _search(np.unique(fps[s:s + z]), threshold)
            a += found[0]
            b += found[1]
        if not a:
            return None
        src, dst = stars(np.concatenate(a), np.concatenate(b))
        return pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), pa.array(dst.view(np.int64))], names=["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n < rows_at_once:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            n_keys = table.num_columns - 1
            last = [table.column(i)[-1].as_py() for i in range(n_keys)]
            # The last bucket may go on in the next batch; it stays until it is whole.
            same = np.all([table.column(i).to_numpy() == v for i, v in enumerate(last)], axis=0)
            cut = int(np.argmax(same))
            if cut:
                out = links(table.slice(0, cut), n_keys)
                if out is not None:
                    yield out
            held = table.slice(cut).to_batches()
            n = len(table) - cut
        if n:
            table = pa.Table.from_batches(held).combine_chunks()
            out = links(table, table.num_columns - 1)
            if out is not None:
                yield out

    return run


def _in_buckets(rows: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    return (rows.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(_link_sorted(threshold), "src bigint, dst bigint"))


def near_links(reps: DataFrame, threshold: int = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Links ``src, dst`` whose components are those of all pairs of ``fp`` within ``threshold`` bits.

    ``reps`` has one row per fingerprint and is read several times, so pass a staged frame.
    """
    spark = reps.sparkSession
    n, both = bit_statistics(reps)
    visits = [(i, _signed(part.mask()), _signed(flip), _signed(top))
              for i, part in enumerate(plan_parts(n, both, threshold)) for flip, top in part.flips()]
    plan = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(m).cast("bigint").alias("mask"),
                              F.lit(f).cast("bigint").alias("flip"), F.lit(t).cast("bigint").alias("top"))
                     for i, m, f, t in visits])
    rows = (reps.select("fp", F.explode(plan).alias("v"))
            .filter((F.col("v.flip") == 0) | (F.col("fp").bitwiseAND(F.col("v.top")) == 0))
            .select(F.col("v.part").alias("part"),
                    F.col("fp").bitwiseAND(F.col("v.mask")).bitwiseXOR(F.col("v.flip")).alias("bucket"), "fp"))
    sizes = stage_rows(rows.groupBy("part", "bucket").agg(F.count(F.lit(1)).alias("n"))
                       .filter(F.col("n") > block)
                       .withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "large-buckets")
    if not sizes.head(1):
        return _in_buckets(rows, ["part", "bucket"], threshold)
    return _link_large(rows, sizes, threshold, block)


def _link_large(rows: DataFrame, sizes: DataFrame, threshold: int, block: int) -> DataFrame:
    """As ``_in_buckets`` when some buckets are larger than a task may hold."""
    dealt = rows.join(sizes.drop("n"), ["part", "bucket"], "left").withColumn(
        "block", F.pmod(F.xxhash64("fp", F.lit(1)), F.coalesce("blocks", F.lit(1))).cast("int"))
    first = stage_rows(_in_buckets(dealt, ["part", "bucket", "block"], threshold), "block-links")
    fps = first.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    label = connected_components(fps, first).withColumnRenamed("node", "fp")
    members = stage_rows(dealt.filter("blocks is not null").join(label, "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")), "large-members")
    main = (members.groupBy("part", "bucket", "component").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("part", "bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                           F.sum("n").alias("all_n"), F.max("n").alias("main_n"))
            .withColumn("rests", F.ceil((F.col("all_n") - F.col("main_n")) / block).cast("int")).filter("rests > 0"))
    members = members.join(main.select("part", "bucket", "main", "rests"), ["part", "bucket"])
    other = members.filter("component <> main").select(
        "part", "bucket", F.pmod(F.xxhash64("fp", F.lit(2)), F.col("rests")).cast("int").alias("rest"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "fp")
    every = members.select("part", "bucket", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("rest"), "block", "fp")
    second = _in_buckets(other.unionByName(every), ["part", "bucket", "rest", "block"], threshold)
    return first.unionByName(second)


def _labelled(rows: DataFrame, threshold: int, block: int) -> DataFrame:
    """One row per fingerprint of the staged ``doc_id, fp``: ``fp, n, component`` (a fingerprint) and ``component_id``; staged."""
    reps = stage_rows(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "fingerprint-reps")
    links = stage_rows(near_links(reps, threshold, block), "near-links")
    nodes = links.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    label = connected_components(nodes, links).withColumnRenamed("node", "fp")
    linked = reps.join(label, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    return stage_rows(linked.join(least, "component").select("fp", "n", "component", "component_id"), "fingerprint-groups")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                words: int = SHINGLE_WORDS, block: int = BLOCK) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id that links of near fingerprints lead to."""
    rows = stage_rows(id_and_text(docs, id_col, text_col).select("doc_id", fingerprint(F.col("text"), words).alias("fp")),
                      "fingerprints")
    return join_groups(rows, _labelled(rows, threshold, block), "fp", "n").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
             words: int = SHINGLE_WORDS, block: int = BLOCK) -> DataFrame:
    """One document of every component, with all its columns: the smallest id, then the smallest hash of its text.

    Ids need not be unique: rows are told apart by id and text.
    """
    rows = stage_rows(id_and_text(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("text_key"), fingerprint(F.col("text"), words).alias("fp")), "fingerprints")
    labels = _labelled(rows, threshold, block)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    # One row per fingerprint before the join, so a hot fingerprint is one row.
    best = rows.groupBy("fp").agg(F.min(first).alias("first")).join(labels, "fp").groupBy("component").agg(F.min("first").alias("first"))
    key, number = unused(docs, "stay_key"), unused(docs, "stay_id")
    stay = best.select(F.col("first.text_key").alias(key), F.col("first.doc_id").alias(number))
    marked = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    kept = marked.alias("m").join(stay.alias("s"), (F.col(f"m.{key}") == F.col(f"s.{key}")) & F.col(f"m.{id_col}").cast("bigint").eqNullSafe(
        F.col(number)), "left_semi")
    return top_per_group(kept, [key, id_col], [F.col(key)], rank_col=unused(marked, "rank")).select(*docs.columns)
