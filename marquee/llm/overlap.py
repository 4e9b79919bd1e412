"""Near-duplicate join on word shingles by a blocked sparse matrix product.

Documents are the rows and distinct shingles the columns of an incidence matrix; a pair's overlap is an
entry of the matrix times its transpose.  Two documents link when their overlap is at least ``percent`` of
their union, which bounds both their sizes and where they must meet: with the columns of every document in
one global order, rare ones first, linked documents share a column among each one's first
``n - ceil(percent * n / 100) + 1``.  The product is built over these columns first, column by column in
blocks that a shuffle by column deals out.

1. One pass reads every document's set: its size, a digest that stands for all documents of an equal
   set, and a sketch of how many sets have each column, added up over the corpus; the sketch has a fixed number of
   cells, whatever the input.  It only orders columns, so its errors cost time and never a link.
2. The first columns are shuffled by column.  Sets that share one are live.
3. In every column each live set meets the column's few most central sets.  Pairs whose overlap in the first columns,
   with all that may lie outside them, stays below the bound are discarded, the others verified by their full rows, for which
   only the texts of their sets are read again.  So a cluster of k near copies costs k rows and not k * k.
4. Columns with the same most central set are one group.  In groups whose sets are still in different components,
   blocks of sets are multiplied with blocks of sets: a task adds up overlap counts over the group's columns, discards
   the pairs that cannot reach the bound and hands on the rest, which go through step 3's checks.

Sets are compared by 64-bit hashes of shingles and of sets: with 10^8 different sets, the chance that any two
have the same digest is below 0.1 %.

Fewer words than a shingle are one shingle; a document without words has an empty set, is linked with
nothing and is its own component.  Null texts are empty.  A component without any id has the id null; repeated rows stay
repeated; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import id_and_text, join_groups, stage_rows
from marquee.operators.components import connected_components
from marquee.operators.ranking import top_per_group

SHINGLE_WORDS = 4
PERCENT = 85
# Cells of the sketch of column counts, and of the block of them that is one row.
CELLS = 1 << 20
CELL_BLOCK = 1 << 14
# Bits of the filter that finds the texts of live sets again; a full one lets more texts through.
FILTER_BITS = 1 << 26
# Sets of a column that all its others are compared with first.
CENTRES = 4
# Most sets on one side of a block of the product.
BLOCK = 2048
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    n = min(words, len(found))
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    # A sum of word hashes, each with its place's own odd factor; the length keeps short sequences apart.
    total = np.full(len(found) - n + 1, n, np.uint64)
    for i in range(n):
        total += _mixed(hashed[i:len(hashed) - n + 1 + i] * _MIX[i % 4] + np.uint64(i))
    return np.unique(_mixed(total))


def set_digest(columns: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(columns.tobytes())).view(np.int64))


def _bytes_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    for x in batch.column(column):
        yield x.as_buffer().to_pybytes()


def _read(words: int):
    """Arrow function over ``doc_id, text_key, text``: a row per document, and at the end the task's sketch in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "node", "n", "block", "cells"]
        counts = np.zeros(CELLS, np.int32)
        seen: set[int] = set()
        for batch in batches:
            nodes, sizes = [], []
            for text in _bytes_of(batch):
                columns = shingles(text, words)
                node = set_digest(columns)
                nodes.append(node)
                sizes.append(len(columns))
                if node not in seen:
                    seen.add(node)
                    np.add.at(counts, (columns % np.uint64(CELLS)).astype(np.int64), np.int32(1))
            rows = len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.list_(pa.int32()))], names=names)
        for block, cells in enumerate(counts.reshape(-1, CELL_BLOCK)):
            if cells.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64())] * 4 + [pa.array([block], pa.int32()), pa.array([cells], pa.list_(pa.int32()))], names=names)

    return run


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sketches, sorted by block, to their sums."""
    last, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "cells"])

    for batch in batches:
        for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells")):
            values = cells.values.to_numpy()
            if block == last:
                total = total + values
                continue
            if last is not None:
                yield row()
            last, total = block, values.astype(np.int64)
    if last is not None:
        yield row()


def column_sketch(read: DataFrame) -> np.ndarray:
    """Counts of columns by cell, capped at 2^31 - 1: a fixed number of cells, collected to be broadcast."""
    blocks = (read.filter("block is not null").select("block", "cells").repartition("block").sortWithinPartitions("block")
              .mapInArrow(_sum_blocks, "block int, cells binary").collect())
    cells = np.zeros(CELLS, np.int32)
    for row in blocks:
        values = np.frombuffer(row["cells"], np.int64)
        cells[row["block"] * CELL_BLOCK:(row["block"] + 1) * CELL_BLOCK] = np.minimum(values, (1 << 31) - 1)
    return cells


def _prefix(sketch, words: int, percent: int):
    """Arrow function over ``text`` to ``col, node, n``: the first columns of every set, rare cells first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = sketch.value
        seen: set[int] = set()
        for batch in batches:
            columns, nodes, sizes = [], [], []
            for text in _bytes_of(batch):
                found = shingles(text, words)
                node = set_digest(found)
                if node in seen or not len(found):
                    continue
                seen.add(node)
                n = len(found)
                first = n - (percent * n + 99) // 100 + 1
                rarity = cells[(found % np.uint64(CELLS)).astype(np.int64)]
                # ``found`` is sorted, so equal cells stay in the order of the hashes.
                columns.append(found[np.argsort(rarity, kind="stable")[:first]])
                nodes.append(node)
                sizes.append(n)
            lengths = [len(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(columns).view(np.int64) if columns else np.zeros(0, np.int64)),
                 pa.array(np.repeat(np.array(nodes, np.int64), lengths)), pa.array(np.repeat(np.array(sizes, np.int64), lengths))],
                names=["col", "node", "n"])

    return run


def _shared_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``col, node``: those of columns that more than one set has, each set once.

    Only the last row is carried on from batch to batch, so a column of any length takes no memory of its own.
    """
    names = ["col", "node", "n"]
    held, shared = None, False
    for batch in batches:
        if not len(batch):
            continue
        rows = [batch.column(c).to_numpy() for c in names]
        if held is not None:
            rows = [np.append(h, r) for h, r in zip(held, rows)]
        col, node = rows[0], rows[1]
        same = col[1:] == col[:-1]
        repeat = same & (node[1:] == node[:-1])
        other = same & ~repeat
        # ``shared`` says whether the held row's column has been found shared, and the held row its set's.
        met = np.zeros(len(col), bool)
        met[1:] |= other
        met[:-1] |= other
        met[0] |= shared
        # The mark goes on along the repeats of a set, both ways.
        group = np.cumsum(np.concatenate(([True], ~repeat)))
        marked = np.zeros(group[-1] + 1, bool)
        np.logical_or.at(marked, group, met)
        last_of = np.concatenate((~repeat, [False]))
        keep = marked[group] & last_of
        yield pa.RecordBatch.from_arrays([pa.array(r[keep]) for r in rows], names=names)
        held, shared = [r[-1:] for r in rows], bool(marked[group[-1]])
    if held is not None and shared:
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in held], names=names)


def live_columns(texts: DataFrame, sketch, words: int, percent: int) -> DataFrame:
    """``col, node, n`` of every first column that at least two sets share; staged."""
    return stage_rows(texts.select("text").mapInArrow(_prefix(sketch, words, percent), "col bigint, node bigint, n bigint")
                      .repartition("col").sortWithinPartitions("col", "node")
                      .mapInArrow(_shared_columns, "col bigint, node bigint, n bigint"), "live-columns")


_PROBES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(_mixed(keys.view(np.uint64) * m) % np.uint64(bits)).astype(np.int64) for m in _PROBES]


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bits of a Bloom filter of ``text_key``: a fixed number of them, however many keys there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.zeros(bits, bool)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(), bits):
                mask[at] = True
        words = np.packbits(mask).view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["at", "word"])

    found = np.zeros(bits // 64, np.int64)
    rows = keys.mapInArrow(run, "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    found[rows.column("at").to_numpy()] = rows.column("word").to_numpy()
    return np.unpackbits(found.view(np.uint8)).astype(bool)


def _sets(mask, words: int, bits: int):
    """Arrow function over ``text_key, text`` to ``node, cols`` of the texts whose keys pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(np.frombuffer(mask.value, np.uint8)).astype(bool)
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column("text_key").to_numpy()
            ok = np.logical_and.reduce([passes[at] for at in _places(keys, bits)])
            chosen = batch.take(pa.array(np.flatnonzero(ok)))
            nodes, columns = [], []
            for key, text in zip(chosen.column("text_key").to_pylist(), _bytes_of(chosen)):
                if key not in seen:
                    seen.add(key)
                    columns.append(shingles(text, words))
                    nodes.append(set_digest(columns[-1]))
            if nodes:
                ends = np.cumsum([0, *map(len, columns)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(columns).view(np.int64)))],
                    names=["node", "cols"])

    return run


def full_sets(texts: DataFrame, read: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, cols``: all columns of the distinct sets ``node``; staged."""
    spark = texts.sparkSession
    keys = read.filter("node is not null").groupBy("node").agg(F.min("text_key").alias("text_key")).join(nodes, "node").select("text_key")
    mask = spark.sparkContext.broadcast(np.packbits(key_filter(keys)).tobytes())
    found = texts.select("text_key", "text").mapInArrow(_sets(mask, words, FILTER_BITS), "node bigint, cols array<bigint>")
    # Several texts, or several tasks, may give the same set.
    return stage_rows(found.join(nodes, "node").groupBy("node").agg(F.first("cols").alias("cols")), "full-sets")


def similar(overlap: Column, both: Column, percent: int) -> Column:
    """Whether an overlap is large enough for two sets of ``both`` columns in all."""
    return overlap * (100 + percent) >= both * percent


def _overlap(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, overlap`` of pairs by the columns that ``sets`` has of both, and the sum of ``n`` and the larger ``rest``, if there."""
    def side(name: str) -> DataFrame:
        return sets.select(*[F.col(c).alias(name if c == "node" else f"{c}_{name}") for c in sets.columns])

    joined = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("overlap", F.size(F.array_intersect("cols_a", "cols_b")))
    if "rest" in sets.columns:
        return joined.select("a", "b", "overlap", (F.col("n_a") + F.col("n_b")).alias("both"), F.greatest("rest_a", "rest_b").alias("rest"))
    return joined.select("a", "b", "overlap", (F.size("cols_a") + F.size("cols_b")).alias("both"))


def possible(pairs: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``a, b`` whose overlap in the first columns leaves them a chance; outside, they share what one of them has at most."""
    met = _overlap(pairs, firsts)
    return met.filter(similar(F.col("overlap") + F.col("rest"), F.col("both"), percent)).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, read: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the staged, distinct pairs ``a, b`` whose full rows overlap enough, as ``src, dst``; staged."""
    sets = full_sets(texts, read, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), words)
    found = _overlap(pairs, sets).filter(similar(F.col("overlap"), F.col("both"), percent))
    return stage_rows(found.select(F.col("a").alias("src"), F.col("b").alias("dst")), "verified-links")


def sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def central_sets(live: DataFrame, centres: int = CENTRES) -> DataFrame:
    """``col, centre, n_centre, place``: every column's most central sets; staged.

    A set is central when its first columns are shared by many: among copies with changes of their own, the original.
    """
    lengths = live.groupBy("col").agg(F.count(F.lit(1)).alias("len"))
    weights = live.join(lengths, "col").groupBy("node").agg(F.sum("len").alias("weight"))
    heads = top_per_group(live.join(weights, "node"), ["col"], [F.desc("weight"), F.asc("node")], centres, rank_col="place")
    return stage_rows(heads.select("col", F.col("node").alias("centre"), F.col("n").alias("n_centre"), "place"), "central-sets")


def central_pairs(live: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a, b`` of every set with the central sets of its columns."""
    met = live.join(heads, "col").filter((F.col("node") != F.col("centre")) & sizes_fit(F.col("n"), F.col("n_centre"), percent))
    return met.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _multiply(percent: int):
    """Arrow function over rows sorted by ``grp, i, j``: the pairs of a block of the product that may be similar."""
    names = ["grp", "i", "j", "left", "node", "col", "part", "n", "rest", "outside"]

    def block(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        sides = []
        for left in (True, False):
            own = rows["left"] == left
            nodes, first, at = np.unique(rows["node"][own], return_index=True, return_inverse=True)
            sides.append((nodes, at, rows["col"][own], {c: rows[c][own][first] for c in ("part", "n", "rest", "outside")},
                          np.bincount(at, minlength=len(nodes))))
        (x, x_at, x_col, x_of, x_here), (y, y_at, y_col, y_of, y_here) = sides
        counts = np.zeros((len(x), len(y)), np.int32)
        # Columns one after the other: each adds one where both sides have it.
        x_at, y_at = x_at[np.argsort(x_col, kind="stable")], y_at[np.argsort(y_col, kind="stable")]
        columns, x_len = np.unique(x_col, return_counts=True)
        y_sorted = np.sort(y_col)
        lo, hi = np.searchsorted(y_sorted, columns), np.searchsorted(y_sorted, columns, side="right")
        start = np.cumsum(x_len) - x_len
        for s, k, a, b in zip(start, x_len, lo, hi):
            counts[x_at[s:s + k, None], y_at[None, a:b]] += 1
        both = x_of["n"][:, None] + y_of["n"][None, :]
        most = (counts + np.minimum((x_of["outside"] - x_here)[:, None], (y_of["outside"] - y_here)[None, :])
                + np.maximum(x_of["rest"][:, None], y_of["rest"][None, :]))
        fits = (np.minimum(x_of["n"][:, None], y_of["n"][None, :]) * 100 >= np.maximum(x_of["n"][:, None], y_of["n"][None, :]) * percent)
        p, q = np.nonzero((counts > 0) & (x_of["part"][:, None] != y_of["part"][None, :]) & fits & (most * (100 + percent) >= both * percent))
        return x[p], y[q]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def pairs(table: pa.Table) -> pa.RecordBatch:
            rows = {c: table.column(c).to_numpy() for c in names}
            a, b = block(rows)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        last = None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in names[:3])))
            start = 0
            for at, key in enumerate(keys):
                if key != last:
                    if at > start:
                        held.append(batch.slice(start, at - start))
                    if held:
                        yield pairs(pa.Table.from_batches(held))
                    held, start, last = [], at, key
            if len(batch) > start:
                held.append(batch.slice(start))
        if held:
            yield pairs(pa.Table.from_batches(held))

    return run


def open_pairs(live: DataFrame, heads: DataFrame, label: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Distinct pairs ``a, b`` of different components that may be similar by what they share in one group of columns.

    A group has the columns with one most central set.  Beyond what is counted there, two sets share no more of their live
    columns than either has outside the group, and no more of the others than one of them has.
    """
    counts = live.groupBy("node").agg(F.count(F.lit(1)).alias("outside"))
    named = live.join(counts, "node").join(label.withColumnRenamed("component", "part"), "node", "left").join(
        heads.filter("place = 1").select("col", F.col("centre").alias("grp")), "col").select(
        "grp", "node", "col", "n", "outside", F.coalesce("part", "node").alias("part"), rest_of(percent).alias("rest"))
    named = stage_rows(named, "live-groups")
    parts = named.groupBy("grp", "part").agg(F.count_distinct("node").alias("sets"))
    sizes = parts.groupBy("grp").agg(F.max_by("part", F.struct("sets", "part")).alias("main"), F.max("sets").alias("most"), F.sum("sets").alias("all"))
    # Sets of a group's main component are not compared with each other.
    sizes = stage_rows(sizes.filter(F.col("all") > F.col("most")).select(
        "grp", "main", F.ceil((F.col("all") - F.col("most")) / block).cast("int").alias("rows"), F.ceil(F.col("all") / block).cast("int").alias("columns")),
        "open-groups")
    mixed = named.join(sizes, "grp")
    deal = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = ["node", "col", "part", "n", "rest", "outside"]
    left = mixed.filter("part <> main").withColumn("i", deal("rows", 1)).withColumn("j", each("columns")).select("grp", "i", "j", F.lit(True).alias("left"), *rest)
    right = mixed.withColumn("j", deal("columns", 2)).withColumn("i", each("rows")).select("grp", "i", "j", F.lit(False).alias("left"), *rest)
    dealt = left.unionByName(right).repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    return dealt.mapInArrow(_multiply(percent), "a bigint, b bigint").distinct()


def rest_of(percent: int) -> Column:
    """How many columns of a set are not among its first."""
    return F.floor((F.col("n") * percent + 99) / 100) - 1


def labels(links: DataFrame) -> DataFrame:
    nodes = links.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return connected_components(nodes, links)


def set_links(texts: DataFrame, read: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Links ``src, dst`` between set digests, with the components of all pairs that are similar enough; staged.

    ``texts`` has ``text_key`` and ``text`` (bytes), ``read`` is the staged result of reading them.
    """
    sketch = texts.sparkSession.sparkContext.broadcast(column_sketch(read))
    live = live_columns(texts, sketch, words, percent)
    firsts = stage_rows(live.groupBy("node").agg(F.first("n").alias("n"), F.collect_list("col").alias("cols")).withColumn("rest", rest_of(percent)), "first-columns")
    heads = central_sets(live)
    tried = stage_rows(possible(central_pairs(live, heads, percent), firsts, percent), "central-pairs")
    first = verified(tried, texts, read, words, percent)
    left = open_pairs(live, heads, labels(first), percent).join(tried, ["a", "b"], "left_anti")
    left = stage_rows(possible(left, firsts, percent), "open-pairs")
    return stage_rows(first.unionByName(verified(left, texts, read, words, percent)), "set-links")


def near_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``: a set's size and the smallest id that links lead to."""
    texts = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    read = stage_rows(texts.mapInArrow(_read(words), "doc_id bigint, text_key bigint, node bigint, n bigint, block int, cells array<int>"), "sets-read")
    rows = read.filter("node is not null").select("doc_id", "node", "n")
    links = set_links(texts, read, words, percent)
    reps = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    linked = stage_rows(reps.join(labels(links), "node", "left").withColumn("component", F.coalesce("component", "node")), "set-components")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    groups = stage_rows(linked.join(least, "component").select("node", "copies", "component_id"), "set-groups")
    named = join_groups(rows.filter("n > 0"), groups, "node", "copies").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return named.unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
