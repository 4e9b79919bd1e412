import random
import re
from collections import Counter, defaultdict

import pytest

from marquee.llm import divergence
from tests.llm.frames import AWKWARD, CLASHES, DOCUMENT, documents, with_clashes

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=3, top=200):
    """``(lang, source, text)`` to the sorted rows of the audit, term by term."""
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = TERM.findall((text or "").translate(LOWER))
        seen[lang or ""].update(set(words))
        counts[lang or "", source or ""].update(words)
    kept = {lang: [w for w, n in c.items() if n >= min_docs] for lang, c in seen.items()}

    def shares(lang, c):
        total = sum(c[w] for w in kept[lang])
        return {w: 1 + 10 ** 9 * (c[w] + 1) // (total + len(kept[lang])) for w in kept[lang]}

    out = []
    p = {g: shares(g[0], c) for g, c in counts.items()}
    for lang, source in counts:
        mine = p[lang, source]
        others = [s for a, s in counts if a == lang and s != source]
        pairs = [(s, sum((mine[w] - p[lang, s][w]) ** 2 // p[lang, s][w] for w in mine)) for s in others]
        q = shares(lang, sum((c for (a, _), c in counts.items() if a == lang), Counter()))
        terms = [(w, (mine[w] - q[w]) ** 2 // q[w]) for w in mine if counts[lang, source][w] and mine[w] > q[w]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(items[:most])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_awkward_documents(spark):
    rows = AWKWARD + [(20 + i, "One word; ONE-word É é élan one_two 3x3", lang, source, 1) for i in range(4) for lang, source in (("en", "a"), (None, "b"))]
    want = brute([(r[2], r[3], r[1]) for r in rows])
    assert want and got(divergence.audit(with_clashes(documents(spark, rows), *CLASHES, "row", "term", "n", "lo"))) == want
    assert got(divergence.audit(documents(spark, []))) == []


@pytest.mark.parametrize("min_docs,top,held", [(3, 200, 200_000), (2, 3, 40), (1, 5, 1)])
def test_random_documents(spark, monkeypatch, min_docs, top, held):
    monkeypatch.setattr(divergence, "SLICE_BYTES", held)
    rng = random.Random(min_docs)
    words = [a + b for a in ("Ab", "b-c", "d", "é") for b in ("x", "y'", "Z", "1q", "")] + ["...", "42", "a,b,a"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 12))), rng.choice(("en", "de", None)), rng.choice("rstuv"), 1) for i in range(90)]
    df = spark.createDataFrame(rows, DOCUMENT).repartition(5)
    assert got(divergence.audit(df, min_docs=min_docs, top=top)) == brute([(r[2], r[3], r[1]) for r in rows], min_docs, top)


def test_a_term_in_two_documents_by_many_chunks_is_not_kept(spark):
    rows = [(1, "word. word, word; (word) word!", "en", "a", 1), (2, "word: word? 'word'", "en", "b", 1), (3, "else", "en", "b", 1)]
    def kept():
        return sorted(map(tuple, divergence.term_counts(spark.createDataFrame(rows, DOCUMENT)).collect()))

    assert kept() == []
    rows.append((4, "[word]", "en", "b", 1))
    assert kept() == [("en", "a", "word", 5), ("en", "b", "word", 4)]


def test_more_documents_to_keep_than_chunks_name(spark):
    with pytest.raises(ValueError):
        divergence.audit(documents(spark), min_docs=4)
