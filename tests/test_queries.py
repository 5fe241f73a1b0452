"""Registered queries against the same queries in SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
# The rest run the same way in the correctness gate; these keep the suite short.
CHOSEN = [
    "parse_kraken",
    "validate_reasons",
    "dedup_sliding_window",
    "dedup_lineitem",
    "dedup_hot_keys",
    "metrics_per_interval",
    "stream_ingest",
]


def test_every_query_has_sql():
    from tickloom.plans.oracles import all_oracles
    from tickloom.plans.queries import all_queries

    assert set(all_queries()) == set(all_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the generated tables")
@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("events", "lineitem", "customer", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(str(tuple(r[c] for c in columns)) for r in df.collect())
    sql = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in sql.description]
    assert sorted(names) == columns
    want = sorted(str(tuple(r[names.index(c)] for c in columns)) for r in sql.fetchall())
    assert got == want
