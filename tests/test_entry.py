"""The driver contract and the registered jobs against DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as ent
from ledgerline.plans import registry
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert {"request_id", "result", "status", "message"} <= set(df.columns)


def test_every_job_has_an_oracle():
    assert set(registry.JOBS) == set(registry.ORACLE)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = digest(ent.queries()[name](spark, SF).toPandas())
    want = digest(duck.sql(ent.oracle_sql()[name]).df())
    assert got[:3] == want[:3]


@pytest.mark.parametrize("name", ["run_durations", "step_failures", "step_status", "lifecycle_snapshot",
                                  "kst_render", "daily_slice"])
def test_time_jobs_do_not_depend_on_session_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Apia")  # UTC-11 in 1970, UTC+13 now
    try:
        got = digest(ent.queries()[name](spark, SF).toPandas())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = digest(duck.sql(ent.oracle_sql()[name]).df())
    assert got[:3] == want[:3]
