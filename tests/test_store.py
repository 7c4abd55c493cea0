from __future__ import annotations

import numpy as np
import pytest

from silexa.functions.totals import total_array
from silexa.operators import store
from silexa.session import shared_dir


def _chunk(i, text, chips, doc_type="idf", path="p"):
    return (i, None, text, "d", doc_type, None, chips, ["r1"], "S", [], [], [f"f{i}()"], path, i, "v", "c")


def test_append_unites_what_comes_together(spark, tmp_path):
    path = str(tmp_path / "store")
    first = spark.createDataFrame([_chunk(3, "x", ["b"]), _chunk(1, "x", ["a"]), _chunk(2, "y", ["a"]), _chunk(4, None, ["c"]), _chunk(5, "", ["d"])], store.CHUNK)
    store.append(first, path)
    got = {r["text"]: r for r in store.read(spark, path).collect()}
    assert set(got) == {"x", "y", None, ""} and got["x"]["chips"] == ["a", "b"] and got["x"]["symbol_refs"] == ["f1()", "f3()"] and got["x"]["chunk_id"] == 1
    store.append(first, path)
    store.append(spark.createDataFrame([_chunk(9, "x", ["z"], path="q"), _chunk(8, "x", ["z"], "trm")], store.CHUNK), path)
    assert store.read(spark, path).count() == 6


def test_delete(spark, tmp_path):
    path = str(tmp_path / "store")
    store.append(spark.createDataFrame([_chunk(1, "x", ["a"]), _chunk(2, "y", ["a"], "trm")], store.CHUNK), path)
    assert store.delete(spark, path, "trm") == 1 and store.delete(spark, path, "src") == 0
    assert [r["doc_type"] for r in store.read(spark, path).collect()] == ["idf"]
    with pytest.raises(ValueError):
        store.delete(spark, path, "pdf")


def test_total_array(spark):
    def fill(batches):
        out = np.zeros(3000)
        for b in batches:
            np.add.at(out, b.column(0).to_numpy(), 1.0)
        return out

    rows = spark.range(0, 9000, 1, 16).selectExpr("id % 2999 AS k")
    want = np.bincount(np.arange(9000) % 2999, minlength=3000)
    assert (total_array(rows, fill, 3000) == want).all()
    assert (total_array(rows.where("false"), fill, 3000) == 0).all()
    assert shared_dir(spark)
