"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources, by code point with the missing source last, weigh 3, 1, 2 and so on and share a
budget of words; a target stops at twice its source's words and what is over goes to the others by
weight, until none is above.  Schedule: slot i of the mix is the golden-ratio point i run through the
cumulated targets, so every stretch of the mix has its sources in proportion; slots are ranked inside
their source.  Each source's documents, shuffled by hash, form a stream of words cut into
blocks of equal size; the k-th slot of a source takes the k-th block, and the stream starts again at
its end.  The last block of a source is cut where its target is met, and the document there is taken in part; a written
mix has whole documents only, so it takes that document whole or not at all, whichever is nearer the target.
Ranks that the points have not reached by the end of the schedule follow at the end of the mix.

Sums run in two steps, by bucket and inside it, so a source with a third of all rows fills no task.
A null text has no words; documents without words are in no block.  A null id is an id of its own.
Repeated rows are one entry with a number of copies and come back as many times.  An empty table, or
one without words, gives targets of 0.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import expand_copies, join_groups, running_sum, stage_rows, unused
from marquee.operators.ranking import number_rows, top_per_group

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 2048
WORD = r"[^\x20\x09-\x0D]+"
# Rows that a step of a running sum is planned to see.
BUCKET_ROWS = 20_000
# The golden ratio's fraction in 2**31 parts, odd.
_GOLDEN, _POINTS = 1_327_217_885, 1 << 31


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, share: float = SHARE, most: float = MOST_REPEATS) -> DataFrame:
    """Add ``source_no``, ``weight``, ``target`` and ``take`` (whole words) to ``src, source_size``; staged."""
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("source_no") % len(WEIGHTS) + 1).cast("int"))
    numbered = stage_rows(number_rows(sources, [F.col("src")], "source_no").withColumn(
        "source_no", F.col("source_no").cast("bigint")).withColumn("weight", weight.cast("double")), "mix-sources")
    budget = share * (numbered.agg(F.sum("source_size")).head()[0] or 0)
    # What a unit of weight gets.  It only rises, and a source is at its limit once its share passes it.
    unit, cap = 0.0, most * F.col("source_size")
    while True:
        free = ~(cap < unit * F.col("weight"))
        limited, weights = numbered.agg(F.sum(F.when(~free, cap)), F.sum(F.when(free, F.col("weight")))).head()
        nxt = (budget - (limited or 0.0)) / weights if weights else unit
        if nxt <= unit:
            break
        unit = nxt
    target = F.least(cap.cast("double"), F.lit(unit) * F.col("weight"))
    return numbered.withColumn("target", target).withColumn("take", F.round(target).cast("bigint"))


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``slot, source_no, rank``: which block of which source stands where in the mix."""
    spark = sources.sparkSession
    many, total = sources.agg(F.count(F.lit(1)), F.sum(F.ceil(F.col("take") / block))).head()
    slots = int(total or 0)
    cells = 4 * max(many, 1)
    ordered = sources.select("source_no", "take", F.ceil(F.col("take") / block).alias("blocks")).filter("blocks > 0")
    ordered = running_sum(ordered.withColumn("bucket", F.floor(F.col("source_no") / BUCKET_ROWS)), [], "bucket",
                          [F.col("source_no")], "blocks", "low")
    spans = ordered.select("source_no", "blocks", (F.col("low") / max(slots, 1)).alias("low"),
                           ((F.col("low") + F.col("blocks")) / max(slots, 1)).alias("high"))
    spans = spans.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1).cast("bigint")))))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), (((F.col("id") + 1) % _POINTS * _GOLDEN) % _POINTS / _POINTS).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * cells))
    drawn = points.join(spans, "cell").filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    ranked = running_sum(drawn.select("slot", "source_no", "blocks", F.lit(1).alias("one"),
                                      F.floor(F.col("slot") / BUCKET_ROWS).alias("bucket")),
                         ["source_no"], "bucket", [F.col("slot")], "one", "rank")
    used = ranked.filter("rank < blocks").select("slot", "source_no", F.col("rank").cast("bigint").alias("rank"))
    have = drawn.groupBy("source_no").agg(F.count(F.lit(1)).alias("have"))
    late = (ordered.join(have, "source_no", "left").withColumn("have", F.coalesce("have", F.lit(0)))
            .filter("have < blocks").select("source_no", F.explode(F.sequence(F.col("have"), F.col("blocks") - 1)).alias("rank"))
            .select((F.lit(slots) + F.col("rank")).alias("slot"), "source_no", "rank"))
    return used.unionByName(late)


def entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            share: float = SHARE) -> DataFrame:
    """One row per document and copy with its place in its source's shuffled stream of words.

    ``doc_id, mark, src, size, copy, source_no, source_size, target, take, offset``
    """
    rows = stage_rows(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), mark(docs, id_col, text_col).alias("mark"),
                    source_key(F.col(source_col)).alias("src"), n_words(F.col(text_col)).alias("size"))
        .groupBy("doc_id", "mark", "src", "size").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("words", F.col("size") * F.col("copies")), "mix-rows")
    sources = source_targets(rows.groupBy("src").agg(
        F.sum("words").cast("bigint").alias("source_size"), F.count(F.lit(1)).alias("entries")), share)
    total = sources.agg(F.sum("entries")).head()[0] or 0
    placed = join_groups(rows, sources.drop("weight"), "src", "entries").withColumn(
        "bucket", F.pmod(F.col("mark"), F.lit(ceil(total / BUCKET_ROWS) or 1)))
    placed = stage_rows(running_sum(placed, ["source_no"], "bucket", [F.col("mark"), F.col("doc_id"), F.col("size")], "words", "offset"),
                        "mix-places")
    return (expand_copies(placed, "copies", "copy")
            .select("doc_id", "mark", "src", "size", "copy", "source_no", "source_size", "target", "take",
                    (F.col("offset") + F.col("copy") * F.col("size")).alias("offset")))


def mark(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """The hash that shuffles documents; rows with the same id and text are copies of one."""
    return F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col))


def source_key(source: Column) -> Column:
    """The source with the missing one made explicit, in code point order, the missing one last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def mix(placed: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """What every slot takes of every document: ``slot, rank, epoch, taken`` beside the entry's columns.

    ``placed`` is a staged frame of ``entries``.  Words are taken from the document's first word on.
    """
    sources = placed.groupBy("source_no").agg(F.max("take").alias("take"))
    slots = schedule(stage_rows(sources, "mix-takes"), block)
    start = F.col("offset") + F.col("epoch") * F.col("source_size")
    parts = (placed.filter("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1))))
             .withColumn("start", start).withColumn("stop", F.least(F.col("start") + F.col("size"), F.col("take")))
             .filter("start < stop")
             .withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block)))))
    overlap = F.least("stop", (F.col("rank") + 1) * block) - F.greatest("start", F.col("rank") * block)
    return parts.withColumn("taken", overlap.cast("bigint")).drop("start", "stop").join(slots, ["source_no", "rank"])


def documents_taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    share: float = SHARE, block: int = BLOCK_WORDS) -> DataFrame:
    """Every document with ``size, source_size, target``, ``taken``, the words the mix takes of it, and ``first_slot``.

    ``first_slot`` is the first slot of the schedule that takes of the document, null if none does.
    """
    placed = stage_rows(entries(docs, id_col, text_col, source_col, share), "mix-entries")
    key = ["doc_id", "mark", "src", "size", "copy"]
    used = mix(placed, block).select(*key, "source_size", "target", "taken", "slot")
    rest = placed.select(*key, "source_size", "target", F.lit(0).cast("bigint").alias("taken"), F.lit(None).cast("bigint").alias("slot"))
    return (used.unionByName(rest).groupBy(*key).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum("taken").alias("taken"),
        F.min("slot").alias("first_slot"))
        .select("doc_id", "size", "source_size", "target", "taken", "first_slot"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    share: float = SHARE, block: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix, whole and with all their columns, once for every time they are taken, in the order of the schedule.

    The document at which a source's target is met is taken whole or not at all, whichever is nearer the target.
    Rows with the same id, source and text are copies and get one of their rows' other columns.
    """
    placed = stage_rows(entries(docs, id_col, text_col, source_col, share), "mix-entries")
    key = ["doc_id", "mark", "src"]
    names = {k: unused(docs, f"mix_{k}") for k in [*key, "slot"]}
    start = F.col("offset") + F.col("epoch") * F.col("source_size")
    parts = mix(placed, block).groupBy(*key, "copy", "epoch", "size", "offset", "source_size", "take").agg(F.min("slot").alias("slot"))
    over, under = start + F.col("size") - F.col("take"), F.col("take") - start
    takes = parts.filter(over <= F.greatest(under, F.lit(0))).select(*[F.col(k).alias(v) for k, v in names.items()])
    rank = unused(docs, "mix_rank")
    # The id as text, so that a missing one is a key too.  Copies are dropped by the keys of the join: texts are dealt out once for both.
    keys = [names["mark"], names["src"], names["doc_id"]]

    def keyed(df: DataFrame, id_: str) -> DataFrame:
        return df.withColumn(names["doc_id"], F.coalesce(F.col(id_).cast("bigint").cast("string"), F.lit("")))

    wide = docs.withColumn(names["mark"], mark(docs, id_col, text_col)).withColumn(names["src"], source_key(F.col(source_col)))
    one = top_per_group(keyed(wide, id_col), keys, [F.col(names["mark"])], rank_col=rank).drop(rank)
    joined = one.join(keyed(takes, names["doc_id"]), keys)
    return joined.orderBy(names["slot"], names["mark"]).select(*docs.columns)
