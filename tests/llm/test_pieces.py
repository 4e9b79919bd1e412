import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import pieces
from tests.llm.frames import AWKWARD, CLASHES, documents, with_clashes

MODEL = pieces.read_model()
LATTICE = pieces.Lattice(MODEL, 0.3, 1)
TABLE = pieces.piece_table(MODEL)


def _encode(texts, keys=None, lattice=LATTICE):
    return lattice.encode(np.array(keys if keys is not None else range(len(texts)), np.int64), pa.array(texts, pa.string()))


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁aeithsn.<0x>é漢😀\x00"), st.characters(exclude_categories=["Cs"])), max_size=80), max_size=6))
def test_decoding_is_lossless(texts):
    assert pieces.decode(_encode(texts), TABLE).to_pylist() == texts


def _segmentations(text):
    """All ways to cut a text into pieces, with their log weights."""
    known = {t: (i, w) for t, i, w in zip(MODEL.text, MODEL.ids, MODEL.weight)}
    if not text:
        yield (), 0.0
    for end in range(1, len(text) + 1):
        if text[:end] in known:
            for rest, weight in _segmentations(text[end:]):
                yield (known[text[:end]][0], *rest), known[text[:end]][1] + weight


@pytest.mark.parametrize("alpha", [0.0, 0.3])
def test_draws_follow_the_lattice(alpha):
    ways = dict(_segmentations(b" then"))
    top = {k: math.exp(alpha * w) for k, w in ways.items()}
    total = sum(top.values())
    n = 20_000
    seen = Counter(map(tuple, _encode(["then"] * n, lattice=pieces.Lattice(MODEL, alpha, 5)).to_pylist()))
    assert set(seen) <= set(ways)
    for way, weight in top.items():
        p = weight / total
        assert abs(seen[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_parts_of_a_row_are_drawn_apart():
    """Equal words of one text are segmented independently."""
    ids = _encode(["then " * 400])[0].as_py()
    joined = [TABLE[i] for i in ids]
    words = [tuple(g) for g in np.split(joined, [k for k, p in enumerate(joined) if p.startswith(b" ") and k])]
    assert len(set(words)) > 3


def test_rows_do_not_depend_on_batch_or_place(monkeypatch):
    texts = [f"some words and more {i} \n" * (i % 5) for i in range(40)]
    whole = _encode(texts).to_pylist()
    assert [_encode([t], [k]).to_pylist()[0] for k, t in enumerate(texts)] == whole
    monkeypatch.setattr(pieces, "BATCH_PARTS", 3)
    assert _encode(texts).to_pylist() == whole
    assert _encode(texts, [7] * 40).to_pylist() != whole


def test_awkward_documents(spark):
    docs = with_clashes(documents(spark), *CLASHES)
    rows = pieces.encoded(docs)
    got = rows.collect()
    assert len(got) == len(AWKWARD) and all(r.lossless for r in got)
    assert sorted(r.decoded for r in got) == sorted(r[1] or "" for r in AWKWARD)
    assert all(len(r.ids) == 0 for r in got if r.decoded == "")
    again = rows.withColumn("again", pieces.decoded(rows)).filter(F.col("again") != F.col("decoded")).count()
    assert again == 0
    assert sorted(map(str, rows.repartition(7).collect())) == sorted(map(str, got))
    assert pieces.encoded(documents(spark, [])).collect() == []


def test_long_part_without_blanks():
    text = "".join(itertools.islice(itertools.cycle("abcdefghij漢"), 30_000))
    assert pieces.decode(_encode([text]), TABLE)[0].as_py() == text
