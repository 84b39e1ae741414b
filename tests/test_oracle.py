"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
# the optional subpackage's queries (opN_*, pipeline) have tests of their own
OWN = sorted(q for q in queries() if q != "pipeline" and not q.startswith("op"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in oracle_sql():
        assert len(rows) > 0
        return
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == [
        "revenue_date", "total_orders", "total_payments", "total_successful_transactions", "gross_revenue"]
