import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marquee.llm import simhash
from tests.llm.frames import AWKWARD, CLASHES, DOCUMENT, documents, with_clashes


def brute_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, threshold=4):
    """``(id, fingerprint)`` to the smallest id that links lead to, for each row."""
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= threshold:
                up[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(rows))]


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(rng, n):
    """Clusters of different density, chains, and fingerprints with many equal bits."""
    out = set()
    while len(out) < n:
        centre = rng.getrandbits(64) & (0xFFFF0000FFFF if rng.random() < 0.5 else (1 << 64) - 1)
        out.add(centre)
        at = centre
        for _ in range(rng.choice((0, 1, 5, 30))):
            at = (at if rng.random() < 0.3 else centre)
            for _ in range(rng.randrange(1, 6)):
                at ^= 1 << rng.randrange(64)
            out.add(at)
    return list(out)[:n]


def test_awkward_documents(spark):
    docs = with_clashes(documents(spark), *CLASHES)
    rows = [(r[0], brute_fingerprint(r[1])) for r in AWKWARD]
    want = sorted(((i, _signed(f), c) for (i, f), c in zip(rows, brute_components(rows))), key=str)
    assert sorted(map(tuple, simhash.near_groups(docs).collect()), key=str) == want
    assert simhash.near_groups(documents(spark, [])).collect() == []


@pytest.mark.parametrize("block,seed", [(1 << 14, 1), (7, 2), (2, 3)])
def test_links_equal_brute_force(spark, block, seed):
    fps = _fingerprints(random.Random(seed), 250)
    reps = simhash.stage_rows(spark.createDataFrame([(_signed(f),) for f in fps], "fp bigint"), "fps")
    links = simhash.near_links(reps, block=block)
    nodes = spark.createDataFrame([(_signed(f),) for f in fps], "node bigint")
    got = {r.node: r.component for r in simhash.connected_components(nodes, links).collect()}
    want = dict(zip(map(_signed, fps), brute_components([(_signed(f), f) for f in fps])))
    assert got == want


@pytest.mark.parametrize("n", [0, 50, 10 ** 5, 10 ** 8, 10 ** 11])
def test_every_plan_finds_every_near_pair(n):
    rng = random.Random(n)
    both = np.full((64, 64), n / 4) + np.diag(np.full(64, n / 4))
    assert max(p.threshold for p in simhash.plan_parts(n, both)) <= 2
    parts = simhash.plan_parts(n, both)
    assert sum(p.threshold + 1 for p in parts) == simhash.THRESHOLD + 1
    visits = [(i, p.mask(), flip, top) for i, p in enumerate(parts) if p.threshold <= 1 for flip, top in p.flips()]
    small = all(p.threshold <= 1 for p in parts)
    for _ in range(200 if small else 0):
        a = rng.getrandbits(64)
        b = a
        for _ in range(rng.randrange(1, 5)):
            b ^= 1 << rng.randrange(64)

        def buckets(x):
            return {(i, (x & mask) ^ flip) for i, mask, flip, top in visits if not flip or not x & top}

        assert buckets(a) & buckets(b)


def test_dense_buckets_leave_a_forest():
    rng = np.random.default_rng(1)
    fps = np.unique(np.bitwise_xor(np.uint64(12345), np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)
                                   | np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)))
    a, b = simhash._search(fps, 4)
    assert sum(map(len, a)) == len(fps) - 1


def test_keep_one_document_of_each_group(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(9, base), (4, base + " tail"), (5, "something else entirely with its own words " * 9), (None, base), (None, "lonely"), (None, "lonely"),
            (30, None), (31, ""), (5, "something else entirely with its own words " * 9)]
    docs = with_clashes(spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCUMENT), *CLASHES)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    comps = brute_components([(k, brute_fingerprint(t)) for k, (_, t) in enumerate(rows)])
    ids = {}
    for (i, _), c in zip(rows, comps):
        ids.setdefault(c, set()).add(i)
    want = sorted(str(min((i for i in found if i is not None), default=None)) for found in ids.values())
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_unlike_texts_of_one_id_both_stay(spark):
    rows = [(7, "one text about this " * 5), (7, "quite another text on that " * 5), (8, "a third"), (8, "a third")]
    kept = simhash.keep_one(spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCUMENT)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(set(rows))
