import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import quality
from tests.llm.frames import CLASHES, documents, with_clashes

FOLDER = "/root/testdata/sf0.01"


def test_trees_equal_a_walk_of_each_row():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(800, 5)).round(1)
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > 0)).astype(float)
    forest = quality.grow_forest(rows, labels, np.ones(800))
    score = forest.score(rows)
    assert ((score > 0.5) == labels).mean() > 0.97
    for row, s in list(zip(rows, score))[:40]:
        margin = forest.base
        for feature, cut, value in zip(forest.feature, forest.cut, forest.value):
            node = 0
            for _ in range(quality.DEPTH):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            margin += value[node - len(feature)]
        assert s == pytest.approx(1 / (1 + np.exp(-margin)))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no labelled tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(with_clashes(docs, *CLASHES), labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert len(held) > 50 and np.mean([r.predicted == r.quality for r in held]) > 0.95
    kept = quality.accepted(with_clashes(docs, *CLASHES), labels)
    assert kept.columns == with_clashes(docs, *CLASHES).columns


def test_awkward_rows_and_labels(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 0, 0), (5, 1, 0), (5, 1, 0), (99, 0, 0)], none.schema)
    got = quality.classify(docs, one).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(documents(spark, []), one).collect() == []


def test_labels_and_source_are_no_inputs(spark):
    docs = documents(spark)
    forest = quality.grow_forest(np.random.default_rng(1).normal(size=(200, len(quality.FEATURES))), np.arange(200) % 2, np.ones(200))
    a = docs.select("text", quality.score(F.col("text"), forest).alias("s")).collect()
    assert len({r.s for r in a if r.text == a[0].text}) == 1
