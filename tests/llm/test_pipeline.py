import os
from collections import Counter

import pytest

import corpus_pipeline
from marquee.llm import quality
from tests.llm import test_exact_dedup, test_mixing, test_simhash
from tests.llm.frames import DOCUMENT

FOLDER = "/root/testdata/sf0.001"
COLUMNS = DOCUMENT.fieldNames()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_every_stage_equals_its_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    out = [docs]
    for f in stages:
        out.append(f(spark, out[-1], FOLDER).cache())
    assert all(df.columns == COLUMNS for df in out[:-1])
    rows = [df.collect() for df in out]

    judged = {r.doc_id: r.predicted for r in quality.classify(docs, labels).collect()}
    assert sorted(r.doc_id for r in rows[1]) == sorted(r.doc_id for r in rows[0] if judged[r.doc_id])

    want = [r[0] for r in test_exact_dedup.brute([(r.doc_id, r.text) for r in rows[1]]) if r[3]]
    assert sorted(r.doc_id for r in rows[2]) == sorted(want)

    prints = [(r.doc_id, test_simhash.brute_fingerprint(r.text)) for r in rows[2]]
    assert sorted(r.doc_id for r in rows[3]) == sorted(set(test_simhash.brute_components(prints)))

    texts = {r.doc_id: r for r in rows[3]}
    _, target = test_mixing.brute_targets([(r.doc_id, r.text, r.source) for r in rows[3]])
    words = Counter()
    for r in rows[4]:
        words[r.source] += test_mixing._size(r.text)
        assert r == texts[r.doc_id]
    longest = Counter()
    for r in rows[3]:
        longest[r.source] = max(longest[r.source], test_mixing._size(r.text))
    assert all(abs(words[s] - target[s]) <= longest[s] / 2 + 1 for s in target)
    assert max(Counter(r.doc_id for r in rows[4]).values()) <= 2

    assert sorted(r.doc_id for r in rows[5]) == sorted(r.doc_id for r in rows[4])
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in rows[5])
    assert corpus_pipeline.run(spark, FOLDER).count() == len(rows[5])
