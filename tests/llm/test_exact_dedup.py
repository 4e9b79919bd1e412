import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from marquee.llm.common import join_groups, join_salted
from marquee.llm.exact_dedup import DigestIndex
from tests.llm.frames import AWKWARD, CLASHES, DOCUMENT, documents, with_clashes


def _digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[_digest(text)].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for digest, members in groups.items():
        members.sort(key=lambda m: m[:3])
        out += [(m[3], members[0][3], len(members), k == 0, digest) for k, m in enumerate(members)]
    return sorted(out, key=str)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_awkward_rows_equal_brute_force(spark):
    docs = with_clashes(documents(spark), *CLASHES)
    assert _rows(DigestIndex(spark).classify(docs)) == brute([(r[0], r[1]) for r in AWKWARD])


def test_empty_table(spark):
    index = DigestIndex(spark)
    assert index.classify(documents(spark, [])).collect() == []
    assert index.rows().count() == 0


def test_second_batch_and_reopened_index(spark):
    first = DigestIndex(spark, buckets=3)
    first.classify(documents(spark, [(1, "a b", None, None, None), (2, "c", None, None, None)]))
    again = DigestIndex(spark, folder=first.folder, buckets=99)
    assert again.buckets == 3
    rows = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in again.classify(
        documents(spark, [(0, "a  b", None, None, None), (5, "new", None, None, None), (4, " new", None, None, None)])).collect()}
    assert rows == {0: (1, False, 1), 5: (4, False, 2), 4: (4, True, 2)}
    assert again.rows().count() == 3


def test_new_rows_keep_all_columns(spark):
    docs = with_clashes(documents(spark), *CLASHES)
    index = DigestIndex(spark)
    kept = index.new_rows(docs)
    assert kept.columns == docs.columns
    want = sorted(str(r[0]) for r in brute([(r[0], r[1]) for r in AWKWARD]) if r[3])
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    # The same batch again is a retry; the same texts in another batch are known.
    assert sorted(str(r.doc_id) for r in index.new_rows(docs).collect()) == want
    assert index.new_rows(docs.filter("doc_id is not null")).count() == 0


def test_a_batch_that_comes_again_gives_the_same_rows(spark):
    first = DigestIndex(spark, buckets=2)
    docs = documents(spark)
    want = _rows(first.classify(docs))
    again = DigestIndex(spark, folder=first.folder)
    assert _rows(again.classify(docs)) == want == brute([(r[0], r[1]) for r in AWKWARD])
    assert again.rows().count() == len({r[4] for r in want})
    other = again.classify(docs.filter("doc_id > 0"))
    assert other.filter("kept").count() == 0
    # A named batch replaces what it wrote before.
    named = DigestIndex(spark, buckets=2)
    named.classify(docs, batch="monday")
    named.classify(docs.filter("doc_id = 7"), batch="monday")
    assert named.rows().count() == 1


def test_release_leaves_no_folder_and_no_table(spark):
    from marquee.session import release, run_folder

    given = DigestIndex(spark, folder=run_folder(spark) + "-kept")
    given.classify(documents(spark))
    index = DigestIndex(spark)
    index.new_rows(documents(spark)).count()
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.exists(at) and index.folder.startswith(run_folder(spark))
    release(spark)
    assert not files.exists(at)
    assert not [t for t in spark.catalog.listTables() if t.name in (index.table, given.table)]
    assert DigestIndex(spark, folder=given.folder).rows().count() > 0


def test_hot_and_other_keys_are_joined_whole(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    want = {i: 0 if i % 3 == 0 else i for i in range(6000)}
    for join in (join_groups, join_salted):
        got = join(rows, groups, "k", "n").collect()
        assert len(got) == 6000 and {r["id"]: r["least"] for r in got} == want


def test_no_group_meets_in_one_task_before_counting(spark):
    """Copies are counted on the map side: what is shuffled is one row per text and task."""
    docs = spark.createDataFrame([(i, "same", "x", "y", 1) for i in range(500)], DOCUMENT)
    out = DigestIndex(spark).classify(docs)
    assert out.filter("kept").count() == 1 and out.agg(F.max("group_size")).head()[0] == 500
