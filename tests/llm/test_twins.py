from __future__ import annotations

import os
from pathlib import Path

import pytest

from silexa.llm import queries

DATA = Path(os.environ.get("SMALL_SF_DIR", "/root/testdata/sf0.001"))


@pytest.mark.skipif(not DATA.is_dir(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twin(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = queries.QUERIES[name](spark, str(DATA))
    ran = con.execute(queries.SQL[name])
    names = [d[0] for d in ran.description]
    assert sorted(names) == sorted(got.columns)
    mine = sorted(tuple(str(r[c]) for c in sorted(names)) for r in got.collect())
    assert mine == sorted(tuple(str(r[names.index(c)]) for c in sorted(names)) for r in ran.fetchall())
