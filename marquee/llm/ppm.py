"""Language-model scores: prediction by partial matching over bytes, and unigram words beside it.

Training counts every byte after its three bytes of context over all training documents.  Shorter
contexts are sums of longer ones.  A byte not seen in its context escapes to the next shorter one
with method C (as many escapes as different bytes seen); there the bytes seen in the longer context
are excluded.  Bytes seen in a context were also seen in every shorter one, so what exclusion takes
away is a fixed sum per context, and the score of every byte in its context is a row of one table.

Work by chunk: documents are dealt into chunks of bounded size, in files bucketed by chunk.  Chunks
send each distinct word and each distinct four bytes once; counts are summed over all chunks and go
back to the chunks, where documents are scored.  Neither counts nor model pass through the driver.

Letters A-Z are lower-cased.  A document's bytes are led by three zero bytes and ended by 0xFF, which
no text has.  A null text is empty: one token, its end.  A null id trains.  Repeated rows count each;
an empty table gives no rows.  With nothing to train on every byte has probability 1/256.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import id_and_text, join_groups, shared_folder, slices, stage_rows
from marquee.session import own_table

HOLD_OUT = (7, 2)
# Bytes of context.
ORDER = 3
CHUNK_BYTES = 8 << 20
# Bytes worked on at once inside a chunk.
SLICE_BYTES = 1 << 20
END = 0xFF


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT[0] == HOLD_OUT[1], F.lit(False))


def _deal(chunk_bytes: int):
    """Number the chunks of a task: rows in their order, a new chunk when one is full."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            total = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)
            numbers = np.empty(len(batch), np.int64)
            start = 0
            while start < len(batch):
                before = total[start - 1] if start else 0
                stop = max(int(np.searchsorted(total, before + chunk_bytes - held, side="right")), start + (not held))
                numbers[start:stop] = chunk
                held += int(total[stop - 1] - before) if stop > start else 0
                if stop < len(batch):
                    chunk, held = chunk + 1, 0
                start = stop
            lower = pc.ascii_lower(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), batch.column(0), lower, batch.column(2)], names=["chunk", "doc_id", "text", "held_out"])

    return run


def dealt(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``chunk, doc_id, text, held_out``: lower-cased documents in files bucketed by chunk.

    The files are written once, so all later steps see the same chunks.  A task writes its own chunks;
    no text is shuffled.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs).withColumn("held_out", held_out(F.col("doc_id")))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    name, folder = own_table(spark, "text_chunks"), shared_folder(spark, "text-chunks")
    (rows.mapInArrow(_deal(chunk_bytes), "chunk bigint, doc_id bigint, text string, held_out boolean")
     .write.bucketBy(int(size // chunk_bytes) + 1, "chunk").option("path", folder).saveAsTable(name))
    return spark.table(name)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Stretches of a batch that lie in one chunk."""
    for batch in batches:
        chunks = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1])) if len(chunks) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(chunks))):
            yield int(chunks[a]), batch.slice(a, b - a)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The four-byte code of every byte with its context, end included, and where each text starts."""
    raw = texts.cast(pa.binary())
    at = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    n = len(raw)
    # Each text gets ORDER bytes in front and one behind.
    padded = np.zeros(len(data) + n * (ORDER + 1), np.uint32)
    shift = np.repeat(np.arange(n) * (ORDER + 1) + ORDER, np.diff(at))
    padded[np.arange(len(data)) + shift] = data
    starts = at[:-1] + np.arange(n) * (ORDER + 1)
    ends = at[1:] + np.arange(n) * (ORDER + 1) + ORDER
    padded[ends] = END
    code = padded[:-ORDER] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    # Codes that would begin inside one text and end in the next are not among those kept.
    keep = np.ones(len(code), bool)
    for k in range(1, ORDER + 1):
        late = ends[:-1] + k - ORDER
        keep[late] = False
    first = starts - np.arange(n) * ORDER
    return code[keep], first


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk, rows in _runs(batches):
        words = pc.ascii_split_whitespace(rows.column(2))
        sizes = pc.list_value_length(words).to_numpy()
        flat = words.flatten()
        train = np.repeat(~rows.column(3).to_numpy(zero_copy_only=False), sizes) & (pc.binary_length(flat).to_numpy() > 0)
        coded = flat.dictionary_encode()
        counts = np.bincount(coded.indices.to_numpy()[train], minlength=len(coded.dictionary))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(counts), chunk)), coded.dictionary, pa.array(counts)], names=["chunk", "word", "n"])


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk, rows in _runs(batches):
        held = rows.column(3).to_numpy(zero_copy_only=False)
        seen, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for wanted in (False, True):
            part = rows.column(2).filter(pa.array(held == wanted))
            for a, b in slices(pc.binary_length(part).to_numpy(), SLICE_BYTES):
                codes, n = np.unique(grams(part.slice(a, b - a))[0], return_counts=True)
                seen = np.concatenate((seen, codes))
                counts = np.concatenate((counts, np.zeros(len(n), np.int64) if wanted else n))
        codes, place = np.unique(seen, return_inverse=True)
        n = np.bincount(place, counts, len(codes)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(codes), chunk)), pa.array(codes.astype(np.int64)), pa.array(n)], names=["chunk", "gram", "n"])


def _low(gram: str, size: int) -> Column:
    """The last ``size`` bytes of a code."""
    return F.col(gram).bitwiseAND(F.lit((1 << 8 * size) - 1).cast("bigint"))


def trie(counts: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
    """Counts ``gram, n`` of the longest contexts to levels and nodes by context length.

    Level k: ``g, c``, the count of a byte after k bytes.  Node k: ``x, total, kinds, taken``: the
    context's counts, its different bytes, and those bytes' count after the context one shorter.
    """
    levels = {ORDER: counts.filter("n > 0").select(F.col("gram").alias("g"), F.col("n").alias("c"))}
    for k in range(ORDER - 1, -1, -1):
        levels[k] = levels[k + 1].groupBy(_low("g", k + 1).alias("g")).agg(F.sum("c").alias("c"))
    nodes = {}
    for k, level in levels.items():
        parts = level.withColumn("x", F.shiftright("g", 8))
        if k:
            shorter = levels[k - 1].select(F.col("g").alias("low"), F.col("c").alias("c_low"))
            parts = parts.withColumn("low", _low("g", k)).join(shorter, "low")
        else:
            parts = parts.withColumn("c_low", F.lit(0).cast("bigint"))
        nodes[k] = parts.groupBy("x").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"),
                                          F.sum("c_low").alias("taken"))
    return levels, nodes


def gram_scores(counts: DataFrame) -> DataFrame:
    """``gram, value``: log10 probability of the last byte of every code after the bytes before it.

    Tables of contexts of two bytes or fewer have at most 65,536 rows and are broadcast.
    """
    levels, nodes = trie(counts)
    out = counts.select("gram", F.when(F.col("n") > 0, F.col("n")).alias(f"c{ORDER}"))
    for k in range(ORDER, -1, -1):
        node = nodes[k].select(F.col("x").alias(f"x{k}"), *[F.col(c).alias(f"{c}{k}") for c in ("total", "kinds", "taken")])
        out = out.withColumn(f"x{k}", F.shiftright(_low("gram", k + 1), 8)).join(
            F.broadcast(node) if k < ORDER else node, f"x{k}", "left")
        if k < ORDER:
            level = levels[k].select(F.col("g").alias(f"g{k}"), F.col("c").alias(f"c{k}"))
            out = out.withColumn(f"g{k}", _low("gram", k + 1)).join(F.broadcast(level) if k < 2 else level, f"g{k}", "left")
    zero = F.lit(0).cast("bigint")
    steps, done = [], F.lit(False)
    for k in range(ORDER, -1, -1):
        # Bytes seen in the context one longer are excluded here.
        taken, kinds = (F.coalesce(F.col(f"taken{k + 1}"), zero), F.coalesce(F.col(f"kinds{k + 1}"), zero)) if k < ORDER else (zero, zero)
        left = F.coalesce(F.col(f"total{k}"), zero) - taken
        fresh = F.coalesce(F.col(f"kinds{k}"), zero) - kinds
        hit = F.col(f"c{k}").isNotNull()
        steps.append(F.when(done, 0.0).when(hit, F.log10(F.col(f"c{k}") / (left + fresh)))
                     .when(fresh > 0, F.log10(fresh / (left + fresh))).otherwise(0.0))
        done = done | hit
    steps.append(F.when(done, 0.0).otherwise(-F.log10(256 - F.coalesce(F.col("kinds0"), zero))))
    return out.select("gram", reduce(lambda a, b: a + b, steps).alias("value"))


def _score(chunk: pa.Table, known: pa.Table) -> pa.Table:
    texts = chunk.column("text").combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    is_word = pc.is_valid(known.column("word"))
    words, codes = known.filter(is_word), known.filter(pc.invert(is_word))
    vocabulary, word_value = words.column("word").combine_chunks(), words.column("value").to_numpy()
    code_set, code_value = codes.column("gram").combine_chunks().cast(pa.uint32()), codes.column("value").to_numpy()
    columns: list[list[np.ndarray]] = [[], [], [], []]
    for a, b in slices(pc.binary_length(texts).to_numpy(), SLICE_BYTES):
        part = texts.slice(a, b - a)
        split = pc.ascii_split_whitespace(part)
        flat = split.flatten()
        owner = np.repeat(np.arange(b - a), pc.list_value_length(split).to_numpy())
        real = pc.binary_length(flat).to_numpy() > 0
        owner, flat = owner[real], flat.filter(pa.array(real))
        value = word_value[pc.index_in(flat, vocabulary).to_numpy()]
        columns[0].append(np.bincount(owner, minlength=b - a))
        columns[1].append(np.bincount(owner[value > 0], minlength=b - a))
        columns[2].append(np.bincount(owner, value, b - a))
        code, first = grams(part)
        logs = code_value[pc.index_in(pa.array(code), code_set).to_numpy()]
        columns[3].append(np.add.reduceat(logs, first) if len(first) else np.zeros(0))
    names = ["words", "known_words", "word_score", "score"]
    return pa.table({"doc_id": chunk.column("doc_id"), "held_out": chunk.column("held_out"),
                     **{n: np.concatenate(c) if c else np.zeros(0) for n, c in zip(names, columns)}}).cast(pa.schema([
                         ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("words", pa.int64()), ("known_words", pa.int64()),
                         ("word_score", pa.float64()), ("score", pa.float64())]))


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    chunks = dealt(docs, chunk_bytes)
    parts = chunks.select("chunk", "doc_id", "text", "held_out")
    word_rows = stage_rows(parts.mapInArrow(_word_counts, "chunk bigint, word string, n bigint").filter("word <> ''"), "chunk-words")
    totals = stage_rows(word_rows.groupBy("word").agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("chunks")), "word-counts")
    ends = chunks.filter(~F.col("held_out")).count()
    tokens, kinds = totals.agg(F.sum("c"), F.count_if(F.col("c") > 0)).head()
    tokens, kinds = (tokens or 0) + ends, kinds + (ends > 0)
    gram_rows = stage_rows(parts.mapInArrow(_gram_counts, "chunk bigint, gram bigint, n bigint"), "gram-counts")
    table = gram_scores(stage_rows(gram_rows.groupBy("gram").agg(F.sum("n").alias("n")), "gram-totals"))
    words = join_groups(word_rows.select("chunk", "word"), totals, "word", "chunks")
    known = words.select("chunk", "word", F.lit(None).cast("bigint").alias("gram"), F.log10(F.col("c") + 1).alias("value")).unionByName(
        gram_rows.select("chunk", "gram").join(table, "gram").select("chunk", F.lit(None).cast("string").alias("word"), "gram", "value"))
    scored = parts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        _score, "doc_id bigint, held_out boolean, words bigint, known_words bigint, word_score double, score double")
    end = float(np.log10(ends + 1))
    each = float(np.log10(tokens + kinds + 1))
    n_tokens = F.col("words") + 1
    return scored.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), (F.col("known_words") + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("word_score") + end - n_tokens * each).alias("base_score"), "score")
