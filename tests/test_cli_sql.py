import os
import subprocess
import sys

import pytest

from ledgerstar.plans import analytics
from ledgerstar.plans.sqlviews import register_views, split_statements
from ledgerstar.plans.star import star_from_testdata

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_split_statements():
    text = "SELECT 1; -- a; comment\nSELECT ';' AS s;\n\nSELECT 2"
    assert split_statements(text) == ["SELECT 1", "SELECT ';' AS s", "SELECT 2"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_sql_on_views_matches_dataframe_query(spark):
    wh = star_from_testdata(spark, SF, "salt")
    register_views(wh)
    sql = """
        SELECT d.hour_of_day, COUNT(*) AS txns,
               COUNT(*) FILTER (WHERE f.is_fraud) AS fraud_txns
        FROM fact_transactions f JOIN dim_date d ON d.date_key = f.date_key
        GROUP BY d.hour_of_day"""
    got = {r["hour_of_day"]: (r["txns"], r["fraud_txns"]) for r in spark.sql(sql).collect()}
    ref = {r["hour_of_day"]: (r["txns"], r["fraud_txns"])
           for r in analytics.q2_2_fraud_by_hour(wh).collect()}
    assert got == ref


def test_block_comments_and_bare_numeric(spark):
    from ledgerstar.plans.sqlviews import run_script
    assert split_statements("SELECT 1 /* a; b */ + 1; SELECT '/*' AS s") == ["SELECT 1   + 1", "SELECT '/*' AS s"]
    for bad in ("SELECT 1.555::numeric", "SELECT CAST(1.5 AS NUMERIC)", "SELECT cast(x as decimal )"):
        with pytest.raises(ValueError, match="without precision"):
            run_script(spark, bad)
    assert str(run_script(spark, "SELECT 1.555::decimal(38, 6) AS x")[0].first().x) == "1.555000"


def test_whole_results_are_written(spark, tmp_dir, monkeypatch):
    from ledgerstar import __main__ as cli
    from ledgerstar.plans import jobs
    wh = star_from_testdata(spark, SF, "salt")
    monkeypatch.setattr("ledgerstar.session.build_spark", lambda **k: spark)
    monkeypatch.setattr(jobs, "read_warehouse", lambda *a: wh)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    assert cli.main(["query", "--warehouse", "w", "--limit", "1", "--output", f"{tmp_dir}/q", "q1_4_hourly"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/q").count() == analytics.q1_4_hourly(wh).count() > 1
    with open(f"{tmp_dir}/two.sql", "w") as f:
        f.write("SELECT * FROM dim_date; SELECT 1 AS x")
    assert cli.main(["sql", "--warehouse", "w", "--output", f"{tmp_dir}/s", f"{tmp_dir}/two.sql"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/s/n=1").count() == wh.dim_date.count()


def test_transform_refuses_without_salt(tmp_dir):
    env = {k: v for k, v in os.environ.items() if k != "MASKING_SALT"}
    r = subprocess.run([sys.executable, "-m", "ledgerstar", "transform", "--input", tmp_dir,
                        "--output", tmp_dir], cwd=ROOT, env=env, capture_output=True, text=True,
                       timeout=120)
    assert r.returncode == 1 and "MASKING_SALT" in r.stderr
