"""Every registered query against its DuckDB oracle on the smallest data set."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["therapy_area", "patients_switched", "switch_rate"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert canon(rows, cols) == canon(orows, ocols)
