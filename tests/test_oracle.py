"""Every catalogued query against its DuckDB oracle at sf0.001."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
import __spark_entry__ as E  # noqa: E402
from tierforge.plans import catalog  # noqa: E402
from oracle_check import TABLES, rows_multiset  # noqa: E402

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    if name not in SQL:
        assert len(srows) >= 0
        return
    cur = con.execute(SQL[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(scols) == sorted(dcols)
    order = sorted(scols)
    assert rows_multiset(srows, [scols.index(c) for c in order]) == rows_multiset(drows, [dcols.index(c) for c in order])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "quarter", "region_name", "nation_name", "market_segment", "order_count",
                          "total_quantity", "net_revenue", "gross_revenue", "tax_collected"]
