import random

import numpy as np
import pyarrow as pa
import pytest

from marquee.llm import overlap
from tests.llm.frames import AWKWARD, CLASHES, DOCUMENT, documents, with_clashes


def brute_set(text, words=4):
    found = (text or "").encode().lower().split()
    n = min(words, len(found))
    return {b" ".join(found[i:i + n]) for i in range(len(found) - n + 1)} if found else set()


def brute(rows, words=4, percent=85):
    """``(id, text)`` to ``(id, set size, smallest id that links lead to)`` for each row."""
    sets = [brute_set(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at:at + rng.choice((0, 1))] = [f"new{rng.randrange(10 ** 6)}"] * rng.choice((0, 1, 1))
    return words


def corpus(seed):
    """Families with chains and stars of edits, shared passages, short texts and texts of a small vocabulary."""
    rng = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(60)] for k in range(3)]
    out = []
    for family in range(12):
        base = [f"f{family}w{rng.randrange(90)}" for _ in range(rng.choice((12, 40, 120)))]
        if rng.random() < 0.5:
            base += rng.choice(passages)
        at = base
        for _ in range(rng.choice((1, 4, 15))):
            at = edited(rng, at if rng.random() < 0.4 else base, rng.randrange(4))
            out.append(" ".join(at))
    out += [" ".join(passages[0] + [f"own{i}w{j}" for j in range(rng.randrange(12))]) for i in range(15)]
    out += [" ".join(rng.choices("abc", k=rng.randrange(0, 9))) for _ in range(25)]
    out += [out[0]] * 20
    rng.shuffle(out)
    return list(enumerate(out))


def test_awkward_documents(spark):
    docs = with_clashes(documents(spark), *CLASHES, "node", "col", "n")
    assert got(overlap.near_sets(docs)) == brute([r[:2] for r in AWKWARD])
    assert got(overlap.near_sets(documents(spark, []))) == []


@pytest.mark.parametrize("seed,centres,percent,words,cells", [(1, 4, 85, 4, 1 << 20), (2, 1, 80, 5, 1 << 14), (3, 1, 60, 2, 1 << 15)])
def test_components_equal_brute_force(spark, monkeypatch, seed, centres, percent, words, cells):
    monkeypatch.setattr(overlap.central_sets, "__defaults__", (centres,))
    monkeypatch.setattr(overlap.open_pairs, "__defaults__", (3 if centres == 1 else overlap.BLOCK,))
    monkeypatch.setattr(overlap, "CELLS", cells)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCUMENT).repartition(5)
    want = brute(rows, words, percent)
    assert len({c for _, _, c in want}) < len(rows)
    assert got(overlap.near_sets(df, words=words, percent=percent)) == want


def test_a_set_of_one_column_is_found_across_batches():
    rng = np.random.default_rng(5)
    rows = sorted((int(c), int(n)) for c, n in zip(rng.integers(0, 60, 200), rng.integers(0, 9, 200)))
    sets = {}
    for c, n in rows:
        sets.setdefault(c, set()).add(n)
    want = sorted((c, n) for c, ns in sets.items() if len(ns) > 1 for n in ns)
    for size in (1, 2, 3, 7, 500):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + size]]), pa.array([r[1] for r in rows[i:i + size]]),
                                               pa.array([1] * len(rows[i:i + size]))], names=["col", "node", "n"]) for i in range(0, len(rows), size)]
        out = [(c, n) for b in overlap._shared_columns(iter(batches)) for c, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        assert out == want
