import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", ["op4_prefix_join", "op6_url_filter", "op11_prefix_suffix_trees", "op13_removal_ranks"])
def test_query_equals_its_sql(spark, name):
    from ledgerstar.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_registered_queries():
    import __spark_entry__ as E
    names = list(E.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names
    assert {n for n in E.oracle_sql() if n.startswith("op")} == {"op4_prefix_join", "op6_url_filter", "op11_prefix_suffix_trees", "op13_removal_ranks"}
