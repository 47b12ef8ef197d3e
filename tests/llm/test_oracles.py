"""The queries of kiln/llm that SQL can express match DuckDB on whole tables."""

import duckdb
import pytest

import __spark_entry__ as E
import kiln.llm
from kiln.llm.registry import ORACLE, QUERIES

TABLES = ("documents", "pages", "benchmark", "labels")


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (r[i] for i in order)) for r in rows), key=repr)


def test_all_operators_are_registered():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())
    assert set(kiln.llm.all_queries()) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    cur = con.execute(ORACLE[name])
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows([d[0] for d in cur.description], cur.fetchall())
