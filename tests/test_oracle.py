"""Every registered query of the engine against its DuckDB oracle at sf0.001
(the driver runs the same comparison at sf0.01); queries of optional
subpackages are tested with them."""

import os

import duckdb
import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from bottomgrid.plans.queries import ORACLES, QUERIES
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLES[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert rows_of(scols, srows) == rows_of(ocols, orows)
