import math
import zlib
from collections import Counter, defaultdict

import pytest

from marquee.llm import ppm
from tests.llm.frames import CLASHES, DOCUMENT, documents, with_clashes


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def _lower(text):
    return (text or "").encode().lower()


def _brute(rows):
    """Scores by walking every byte down from its longest context."""
    seen = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    words = Counter()
    for i, text in rows:
        if _held(i):
            continue
        words.update([*_lower(text).split(), None])
        data = bytes(ppm.ORDER) + _lower(text) + bytes([ppm.END])
        for at in range(ppm.ORDER, len(data)):
            for k in range(ppm.ORDER + 1):
                seen[k][data[at - k:at]][data[at]] += 1
    n, v = sum(words.values()), len(words)
    out = []
    for i, text in rows:
        data, total = bytes(ppm.ORDER) + _lower(text) + bytes([ppm.END]), 0.0
        for at in range(ppm.ORDER, len(data)):
            excluded = set()
            for k in range(ppm.ORDER, -1, -1):
                here = {s: c for s, c in seen[k].get(data[at - k:at], {}).items() if s not in excluded}
                if not here:
                    continue
                whole = sum(here.values()) + len(here)
                if data[at] in here:
                    total += math.log10(here[data[at]] / whole)
                    break
                total += math.log10(len(here) / whole)
                excluded |= set(here)
            else:
                total -= math.log10(256 - len(excluded))
        tokens = [*_lower(text).split(), None]
        base = sum(math.log10((words[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((i, _held(i), len(tokens), sum(words[t] > 0 for t in tokens), n, base, total))
    return out


def _key(row):
    return (row[0] is None, row[0] or 0, *row[1:4], round(row[5], 6))


@pytest.mark.parametrize("chunk", [40, 1 << 20])
def test_scores_equal_a_walk_over_every_byte(spark, chunk):
    text = "The cat sat on the mat. The dog sat on the log; a CAT is no dog."
    rows = [(i, " ".join(text.split()[i % 7:7 + i % 5]) + "é" * (i % 3)) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "a b\n a"), (102, " \t\n"), (7, rows[7][1]), (200, "never seen ϖ zzz qqq" * 50)]
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCUMENT)
    got = sorted((tuple(r) for r in ppm.score(with_clashes(docs, *CLASHES), chunk).collect()), key=_key)
    want = sorted(_brute(rows), key=_key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-6) and g[6] == pytest.approx(w[6], abs=1e-6)


def test_no_training_rows_and_no_rows(spark):
    held = next(i for i in range(100) if _held(i))
    row = ppm.score(documents(spark, [(held, "ab", None, None, None)])).collect()[0]
    assert (row.n_tokens, row.n_known, row.train_tokens) == (2, 0, 0)
    assert row.base_score == 0 and row.score == pytest.approx(-3 * math.log10(256))
    assert ppm.score(documents(spark, [])).collect() == []
