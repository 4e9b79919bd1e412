import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import repetition
from tests.llm.frames import AWKWARD, CLASHES, documents, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_longest_repeats_equal_brute_force(tokens):
    def common(i, j):
        k = 0
        while max(i, j) + k < len(tokens) and tokens[i + k] == tokens[j + k]:
            k += 1
        return k

    want = [max([common(i, j) for j in range(len(tokens)) if j != i], default=0) for i in range(len(tokens))]
    assert repetition.longest_repeats(np.array(tokens, np.int64)).tolist() == want


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeated = set()
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    for places in windows.values():
        if len(places) > 1:
            repeated.update(p + k for p in places for k in range(3))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["aa", "b", "ccc", "d|#", "é漢", "x*", "y z"]
    rows = [(100 + i, "".join(rng.choice(vocabulary) + rng.choice((" ", "\n", "  ", "\t")) for _ in range(rng.randrange(120))),
             None, None, None) for i in range(60)] + AWKWARD
    got = repetition.judge(with_clashes(documents(spark, rows), *CLASHES)).collect()
    found = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert found == sorted((r[0] or 0, *brute(r[1])) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.n_covered <= r.n_repeat_words and not (r.base_failed and r.kept)


def test_verdict(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(4000)]
    clean = " ".join(rng.sample(words, 300))
    long = " ".join(rng.sample(words, 1200))
    passage = " ".join(f"p{i}" for i in range(150))
    rows = [(1, clean), (2, f"{long} {passage} {long[::-1]} {passage}"), (3, clean + "\n" + " ".join(words[:10]) + "\n" + " ".join(words[:10])),
            (4, " ".join([" ".join(words[:60])] * 9))]
    got = {r.doc_id: r for r in repetition.judge(documents(spark, [(i, t, None, None, None) for i, t in rows])).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, False, True, False]
    assert got[2].longest_repeat == 150 and not got[2].base_failed
    assert repetition.judge(documents(spark, [])).collect() == []
