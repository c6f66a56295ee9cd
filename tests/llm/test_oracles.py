"""The text queries that SQL can express against their DuckDB oracles."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import rows_of

SF = "/root/testdata/sf0.001"
NAMES = ("op10_licenses", "op11_merkle_manifest", "op2_ngram_jaccard", "op3_decontamination", "op7_quality_rules")


@pytest.mark.parametrize("name", NAMES)
def test_text_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_every_text_oracle_is_run():
    assert set(NAMES) == set(entry.LLM_ORACLES)
