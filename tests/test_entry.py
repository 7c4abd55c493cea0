from __future__ import annotations

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = Path(os.environ.get("SMALL_SF_DIR", "/root/testdata/sf0.001"))
needs_data = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables")


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 50


@needs_data
def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["raw_id", "doc_type", "tier"] and got.count() == 50


def _comparable(rows: list[tuple]) -> list[tuple]:
    return sorted(tuple("" if x is None or x != x else f"{x:.6g}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@needs_data
@pytest.mark.parametrize("name", sorted(entry.core.SQL))
def test_sql_twin(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = entry.queries()[name](spark, str(DATA))
    ran = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in ran.description]
    assert sorted(names) == sorted(got.columns)
    assert _comparable([tuple(r[c] for c in sorted(names)) for r in got.collect()]) == _comparable([tuple(r[names.index(c)] for c in sorted(names)) for r in ran.fetchall()])
