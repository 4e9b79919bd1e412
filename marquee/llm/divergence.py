"""How the sources of a language differ in their words, by chunk factorization.

Texts are cut at blanks into chunks.  Chunks are counted once per document inside the task that reads
it, then added up over the corpus, a bucket of chunks at a time; every distinct chunk is tokenized once in its
bucket, and its terms are joined back to the counts.  So the cost of tokenizing grows with the vocabulary of
chunks, not with the corpus.  Counts travel from task to task as compressed blocks of columns.

Terms are runs of ASCII letters and characters outside ASCII, with A-Z lower-cased.  A language keeps the
terms that at least ``min_docs`` of its documents have.  Only chunks in fewer documents need to name them,
and of at most two documents the smallest and largest number are all, so ``min_docs`` is at most 3.

All shares are whole numbers: ``p = 1 + floor(10^9 * (count + 1) / (N + V))`` with N the group's occurrences of
kept terms and V their number; ``f = floor((p - q)^2 / q)`` measures one term.  A term that neither of two
sources has counts the same for every such term, so pairs of sources are built from the terms they do have.

Null texts, languages and sources are empty; every row is a document, repeated ones too.  A group without
terms has counts of 0, a language without kept terms pairs of value 0.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import join_groups, slices, stage_rows
from marquee.operators.ranking import top_per_group

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
MIN_DOCS = 3
TOP = 200
ONE = 1_000_000_000
# Bytes of text that a task counts at once.
SLICE_BYTES = 16 << 20
_COUNTS = ["n", "docs", "lo", "hi"]


def _packed(table: pa.Table, hashes: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row ``bucket, block`` for every bucket of a table's rows, the block compressed by columns."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    table, cuts = table.take(pa.array(order)), np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in range(buckets):
        if cuts[k] < cuts[k + 1]:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.slice(cuts[k], cuts[k + 1] - cuts[k]).combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             names=["bucket", "block"])


def _opened(blocks: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b.as_buffer()).read_all() for b in blocks]).unify_dictionaries()


def _hashes(values: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, values.to_pylist()), np.uint64, len(values))


def _codes(*columns: pa.ChunkedArray) -> np.ndarray:
    """One number for each distinct row of the columns."""
    out = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        code = column.combine_chunks()
        code = code if pa.types.is_dictionary(code.type) else code.dictionary_encode()
        out = np.unique(out * (len(code.dictionary) + 1) + code.indices.to_numpy(), return_inverse=True)[1]
    return out


def _count(buckets: int, min_docs: int):
    """Arrow function over documents to packed ``lang, source, chunk, n, docs, lo, hi``.

    Chunks in ``min_docs`` documents need not name them (-1).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column("text")).to_numpy(), SLICE_BYTES):
                part = batch.slice(a, b - a)
                split = pc.ascii_split_whitespace(part.column("text"))
                flat, owner = split.flatten(), np.repeat(np.arange(b - a), pc.list_value_length(split).to_numpy())
                real = pc.binary_length(flat).to_numpy() > 0
                words = flat.filter(pa.array(real)).dictionary_encode()
                if not len(words):
                    continue
                many = len(words.dictionary)
                pair, times = np.unique(owner[real] * many + words.indices.to_numpy(), return_counts=True)
                doc, word = pair // many, pair % many
                groups = pa.Table.from_batches([part.select(["lang", "source"])])
                key = _codes(groups.column(0), groups.column(1))[doc] * many + word
                # Documents stay in order inside a group's chunk.
                order = np.argsort(key, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
                last = np.append(first[1:], len(order)) - 1
                doc, docs = doc[order], last - first + 1
                rows = part.column("row").to_numpy()
                few = docs < min_docs
                chunk = word[order][first]
                yield from _packed(pa.table({
                    "lang": groups.column(0).take(pa.array(doc[first])).combine_chunks().dictionary_encode(),
                    "source": groups.column(1).take(pa.array(doc[first])).combine_chunks().dictionary_encode(),
                    "chunk": words.dictionary.take(pa.array(chunk)).cast(pa.binary()), "n": np.add.reduceat(times[order], first),
                    "docs": docs, "lo": np.where(few, rows[doc[first]], -1), "hi": np.where(few, rows[doc[last]], -1)}),
                    _hashes(words.dictionary)[chunk], buckets)

    return run


def _merged(table: pa.Table, keys: list[str], min_docs: int, disjoint: bool) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Rows of equal keys as one: the first row of each, and its counts.

    ``disjoint`` rows count different documents.  Otherwise a key's documents are those of one row that has enough, or
    those that all rows name.
    """
    code = _codes(*(table.column(k) for k in keys))
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
    n, docs, lo, hi = (table.column(c).to_numpy()[order] for c in _COUNTS)
    if disjoint:
        found = np.add.reduceat(docs, first)
    else:
        found = np.maximum.reduceat(docs, first)
    far = np.iinfo(np.int64).max
    low = np.minimum.reduceat(np.where(lo < 0, far, lo), first)
    high = np.maximum.reduceat(hi, first)
    if not disjoint:
        at = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        third = (lo >= 0) & (((lo != low[at]) & (lo != high[at])) | ((hi != low[at]) & (hi != high[at])))
        named = np.where(np.logical_or.reduceat(third, first), 3, 1 + (low != high))
        found = np.maximum(found, np.where(high < 0, 0, named))
    few = found < min_docs
    return order[first], {"n": np.add.reduceat(n, first), "docs": found, "lo": np.where(few, low, -1), "hi": np.where(few, high, -1)}


def _terms(buckets: int, min_docs: int):
    """Arrow function over one bucket of chunks to packed ``lang, source, term, n, docs, lo, hi``."""
    def run(table: pa.Table) -> pa.Table:
        chunks = _opened(table.column("block"))
        rows, counts = _merged(chunks, ["lang", "source", "chunk"], min_docs, disjoint=True)
        chunks = chunks.take(pa.array(rows))
        distinct = chunks.column("chunk").combine_chunks().dictionary_encode()
        found = [TERM.findall(c.lower()) for c in distinct.dictionary.to_pylist()]
        many = np.array([len(f) for f in found], np.int64)
        terms = pa.array([t for f in found for t in f], pa.binary())
        # The terms of a row's chunk, joined back by the chunk's number.
        code = distinct.indices.to_numpy()
        start = (np.cumsum(many) - many)[code]
        at = np.repeat(np.arange(len(code)), many[code])
        inside = np.arange(len(at)) - np.repeat(np.cumsum(many[code]) - many[code], many[code])
        if not len(at):
            return pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.binary())})
        spread = pa.table({"lang": chunks.column("lang").take(pa.array(at)), "source": chunks.column("source").take(pa.array(at)),
                           "term": terms.take(pa.array(start[at] + inside)), **{c: v[at] for c, v in counts.items()}})
        rows, counts = _merged(spread, ["lang", "source", "term"], min_docs, disjoint=False)
        few = spread.select(["lang", "source", "term"]).take(pa.array(rows))
        term = few.column("term").combine_chunks().dictionary_encode()
        out = pa.table({**{c: few.column(c) for c in few.column_names}, **counts})
        return pa.Table.from_batches(list(_packed(out, _hashes(term.dictionary)[term.indices.to_numpy()], buckets)))

    return run


def _kept(min_docs: int):
    """Arrow function over one bucket of terms to the kept ``lang, source, term, n``."""
    def run(table: pa.Table) -> pa.Table:
        terms = _opened(table.column("block"))
        rows, counts = _merged(terms, ["lang", "source", "term"], min_docs, disjoint=False)
        own = pa.table({**{c: terms.column(c).take(pa.array(rows)) for c in ("lang", "source", "term")}, **counts})
        rows, counts = _merged(own, ["lang", "term"], min_docs, disjoint=False)
        enough = np.zeros(len(own), bool)
        code = _codes(own.column("lang"), own.column("term"))
        enough[code[rows]] = counts["docs"] >= min_docs
        own = own.select(["lang", "source", "term", "n"]).filter(pa.array(enough[code]))
        return own.cast(pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64())]))

    return run


def _named(docs: DataFrame, **columns: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for a, c in columns.items()]


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """Kept terms of every group that has them: ``lang, source, term, n``; staged."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.monotonically_increasing_id().alias("row"), *_named(docs, lang=lang_col, source=source_col, text=text_col))
    packed = "bucket int, block binary"
    chunks = given.mapInArrow(_count(buckets, min_docs), packed)
    terms = chunks.groupBy("bucket").applyInArrow(_terms(buckets, min_docs), packed)
    return stage_rows(terms.groupBy("bucket").applyInArrow(_kept(min_docs), "lang string, source string, term string, n bigint"), "term-counts")


def share(count: Column, n: Column, v: Column) -> Column:
    """The whole-number share of a term; products pass 64 bits, so they are decimals."""
    wide = F.lit(ONE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", wide, F.greatest(n + v, F.lit(1)).cast("decimal(20,0)"))


def measure(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_totals(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """Of the distinct ``lang, source``: ``lang, source, total`` (occurrences of kept terms), ``kept`` (the language's kept terms), ``terms`` (the group's); staged."""
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    kept = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    zero = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("total", "terms", "kept")}
    return stage_rows(groups.join(own, ["lang", "source"], "left").join(kept, "lang", "left").withColumns(zero), "group-totals")


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item`` (another source of the language), ``value``: f summed over all kept terms.

    With p0 and q0 the shares of a missing term, the sum is that of f(p0, q0) over all kept terms, corrected for the
    terms of the one source, for those of the other, and for those of both.  The first two corrections need each source's
    numbers of terms by count only.
    """
    one = groups.select("lang", "source", F.col("total").alias("n1"), "kept", share(F.lit(0), F.col("total"), F.col("kept")).alias("p0"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("n2"), share(F.lit(0), F.col("total"), F.col("kept")).alias("q0"))
    pairs = stage_rows(one.join(two, "lang").filter("source <> item"), "source-pairs")
    p0, q0 = F.col("p0"), F.col("q0")
    all_missing = pairs.select("lang", "source", "item", (F.col("kept") * measure(p0, q0)).alias("value"))
    by_count = stage_rows(counts.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("times")), "counts-of-counts")
    p, q = share(F.col("n"), F.col("n1"), F.col("kept")), share(F.col("n"), F.col("n2"), F.col("kept"))
    left = pairs.join(by_count, ["lang", "source"]).select("lang", "source", "item", (
        F.col("times") * (measure(p, q0) - measure(p0, q0))).alias("value"))
    right = pairs.join(by_count.withColumnRenamed("source", "item"), ["lang", "item"]).select("lang", "source", "item", (
        F.col("times") * (measure(p0, q) - measure(p0, q0))).alias("value"))
    # Terms of both: a row for each pair of sources that share one, as counts of pairs of counts.
    other = counts.select("lang", "term", F.col("source").alias("item"), F.col("n").alias("m"))
    shared = (counts.join(other, ["lang", "term"]).filter("source <> item").groupBy("lang", "source", "item", "n", "m")
              .agg(F.count(F.lit(1)).alias("times")))
    q_both = share(F.col("m"), F.col("n2"), F.col("kept"))
    both = pairs.join(shared, ["lang", "source", "item"]).select("lang", "source", "item", (
        F.col("times") * (measure(p, q_both) - measure(p, q0) - measure(p0, q_both) + measure(p0, q0))).alias("value"))
    return all_missing.union(left).union(right).union(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item`` (a term), ``value`` of every term that a group has and uses more than its language does."""
    own = join_groups(counts, groups.select("lang", "source", "total", "kept", "terms"), ["lang", "source"], "terms")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("terms").alias("entries"), F.max("kept").alias("lang_kept"))
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("entries"))
    totals = stage_rows(of_lang, "language-terms")
    q_rows = join_groups(totals.withColumnRenamed("entries", "in_groups"), langs, "lang", "entries")
    q = q_rows.select("lang", "term", share(F.col("lang_n"), F.col("lang_total"), F.col("lang_kept")).alias("q"))
    return (own.join(q, ["lang", "term"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept"))).filter("p > q")
            .select("lang", "source", F.col("term").alias("item"), measure(F.col("p"), F.col("q")).alias("value")))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS,
          top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: all pairs of sources and each group's ``top`` terms."""
    if not 1 <= min_docs <= 3:
        raise ValueError("min_docs must be 1, 2 or 3: a chunk in fewer documents names only the first and the last")
    counts = term_counts(docs, lang_col, source_col, text_col, min_docs)
    groups = group_totals(docs.select(*_named(docs, lang=lang_col, source=source_col)).distinct(), counts)
    order = [F.desc("value"), F.asc("item")]
    pairs = top_per_group(pair_values(counts, groups), ["lang", "source"], order, 1 << 30, rank_col="rank")
    terms = top_per_group(term_values(counts, groups), ["lang", "source"], order, top, rank_col="rank")

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(pairs, "pair").unionByName(part(terms, "term"))
