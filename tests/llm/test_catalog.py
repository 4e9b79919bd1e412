import os

import pytest

from marquee.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.select(*columns).fetchall()))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
