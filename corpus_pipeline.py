"""Corpus pipeline: quality, exact copies, near copies, mixing, tokenization.

Every stage takes what the one before kept.  All but the last return the columns of ``documents``;
the last returns one row per document of the mix with its piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import exact_dedup, mixing, pieces, quality, simhash
from marquee.llm.common import stage_rows


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, fitted on the labelled documents of the input."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest row of every text, blanks aside, through a new digest index."""
    return exact_dedup.DigestIndex(spark).new_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that near fingerprints link."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once for every time they are taken."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and sampled piece ids, their number, the digest of the decoded text, and whether it is the document's."""
    return pieces.summary(pieces.encoded(docs))


STAGES = [
    ("quality classifier", classify_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# Trees, fingerprint components, schedules and sampled pieces have no plain SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage returns is written before the next one reads it."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = stage_rows(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir)
