import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquee.llm import mixing
from tests.llm.frames import AWKWARD, CLASHES, DOCUMENT, documents, with_clashes


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(rows):
    """Share out what is over until no source is above twice its size."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + _size(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    over, free = 1.5 * sum(sizes.values()), set(order)
    while over > 1e-9 and free:
        unit = over / sum(weight[s] for s in free)
        over = 0.0
        for s in list(free):
            target[s] += unit * weight[s]
        for s in list(free):
            if target[s] >= 2 * sizes[s]:
                over += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    return sizes, target


def _check(spark, rows, block, **options):
    docs = with_clashes(documents(spark, [(i, t, "x", s, 1) for i, t, s in rows]), *CLASHES)
    got = mixing.documents_taken(docs, block=block, **options).collect()
    sizes, target = brute_targets(rows)
    assert sorted((r.doc_id or 0, r.size) for r in got) == sorted((i or 0, _size(t)) for i, t, _ in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    by_target = {}
    for r in got:
        by_target.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
    want = {}
    for s in sizes:
        want[(sizes[s], round(target[s], 6))] = want.get((sizes[s], round(target[s], 6)), 0) + round(target[s])
    assert {k: sum(v) for k, v in by_target.items()} == pytest.approx(want, abs=1)
    return docs, got


@pytest.mark.parametrize("block,bucket", [(1, 5), (7, 3), (2048, 20_000)])
def test_targets_and_taken_words(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rng = random.Random(block)
    sources = ["a", "b", None, "é", "Z", "tiny", "none"]
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), rng.choice(sources[:5])) for i in range(120)]
    rows += [(500, "just three words", "tiny"), (501, "", "none"), (502, None, "none"), (7, "again", "a"), (7, "again", "a"), (None, "no id", "a"),
             (None, "no id", "a"), (503, "long " * 3000, "b")]
    _check(spark, rows, block)


def test_awkward_documents(spark):
    _check(spark, [(r[0], r[1], r[3]) for r in AWKWARD], 16)
    assert mixing.documents_taken(documents(spark, [])).collect() == []
    rows = mixing.documents_taken(documents(spark, [(1, None, None, "a", 0)])).collect()
    assert [(r.size, r.taken, r.target) for r in rows] == [(0, 0, 0.0)]


def test_every_stretch_of_the_mix_has_its_proportions(spark):
    frame = spark.createDataFrame([(0, 3000, 3000), (1, 1000, 1000), (2, 2000, 2000)], "source_no bigint, take bigint, blocks bigint")
    slots = sorted((r.slot, r.source_no, r["rank"]) for r in mixing.schedule(frame.select("source_no", "take"), block=1).collect())
    assert len(slots) == 6000
    for source, take in ((0, 3000), (1, 1000), (2, 2000)):
        assert sorted(r for _, s, r in slots if s == source) == list(range(take))
    for at in range(0, 5400, 600):
        window = [s for _, s, _ in slots[at:at + 600]]
        assert abs(window.count(0) - 300) <= 6 and abs(window.count(1) - 100) <= 6


def test_mixed_documents_are_whole_and_near_their_targets(spark):
    rng = random.Random(4)
    rows = [(i, f"t{i}\n" + "  ".join(["w"] * rng.randrange(1, 30)), rng.choice("abc")) for i in range(80)] + [(3, "same row", "a"), (3, "same row", "a"), (None, "x y", None)]
    docs, _ = _check(spark, rows, 8)
    mixed = mixing.mixed_documents(docs, block=8)
    assert mixed.columns == docs.columns
    got = mixed.collect()
    assert {(r.doc_id, r.text, r.source) for r in got} <= set(rows)
    times = Counter((r.doc_id, r.text, r.source) for r in got)
    assert all(n <= 2 * rows.count(row) for row, n in times.items())
    _, target = brute_targets(rows)
    for source in target:
        words = sum(_size(r.text) for r in got if r.source == source)
        assert abs(words - target[source]) <= max(_size(t) for _, t, s in rows if s == source) / 2 + 1
    assert list(map(str, mixing.mixed_documents(docs, block=8).collect())) == list(map(str, got))
    assert mixing.mixed_documents(spark.createDataFrame([], DOCUMENT)).collect() == []


def test_the_written_mix_is_in_the_order_of_the_schedule(spark):
    docs = documents(spark, [(i, " ".join(["w"] * 4), "x", "abc"[i % 3], 1) for i in range(900)])
    sources = [r.source for r in mixing.mixed_documents(docs, block=4, share=0.5).collect()]
    assert len(sources) == 450
    for at in range(0, 420, 60):
        window = sources[at:at + 60]
        assert abs(window.count("a") - 30) <= 5 and abs(window.count("b") - 10) <= 5 and abs(window.count("c") - 20) <= 5


def test_one_row_is_a_third_of_the_table(spark):
    rows = [(i, f"t{i} w", "a") for i in range(200)] + [(500, "hot row here", "b")] * 100
    docs, got = _check(spark, rows, 8)
    assert sum(r.doc_id == 500 for r in got) == 100
    from marquee.llm.common import expand_copies

    many = mixing.stage_rows(spark.createDataFrame([("hot", 50_000), ("one", 1)], "k string, copies bigint"), "many-copies")
    out = expand_copies(many, "copies", "copy", piece=100)
    assert sorted(r.n for r in out.groupBy("k").agg(F.countDistinct("copy").alias("n")).collect()) == [1, 50_000]
    per_task = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) < 40_000


def test_documents_follow_the_schedule(spark):
    """By first slot, stretches of the documents taken have their sources in proportion; without it they have no order."""
    rows = [(i, " ".join(["w"] * 4), "abc"[i % 3]) for i in range(900)]
    docs = documents(spark, [(i, t, "x", s, 1) for i, t, s in rows])
    got = mixing.documents_taken(docs, block=4, share=0.5).collect()
    source = {i: s for i, _, s in rows}
    taken = sorted((r.first_slot, source[r.doc_id]) for r in got if r.taken)
    assert all((r.first_slot is None) == (r.taken == 0) for r in got)
    assert len({slot for slot, _ in taken}) == len(taken) == 450
    # The sources weigh 3, 1 and 2.
    for at in range(0, 420, 60):
        window = [s for _, s in taken[at:at + 60]]
        assert abs(window.count("a") - 30) <= 5 and abs(window.count("b") - 10) <= 5 and abs(window.count("c") - 20) <= 5


def test_texts_are_dealt_out_once_for_copies_and_takes(spark):
    """What the window that drops copies deals out, the join with the takes uses as it is; the order deals the mix out once more."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mixing.mixed_documents(documents(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Exchanges of the part of the plan that holds the texts, from the order down to the scan of the documents.
    above = plan[:plan.index("Window [row_number()")]
    assert above.count("Exchange rangepartitioning") == 1 and above.count("Exchange hashpartitioning") == 0
