"""Every query with an oracle: Spark result == DuckDB result at sf0.001."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_named_in_both_or_rows_only():
    assert set(ORACLE) <= set(QUERIES)
    assert {q for q in set(QUERIES) - set(ORACLE) if q != "pipeline" and not q.startswith("op")} == set()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF, con)
    assert r["cols_ok"], (r["spark_cols"], r["duck_cols"])
    assert r["spark_rows"] == r["duck_rows"]
    assert r["exact"], r["first_diff"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user1", "lifetime", "num_friends", "cum_num_friends"]
    rows = df.collect()
    users = {r.user1 for r in rows}
    assert len(rows) == 13 * len(users) > 0
