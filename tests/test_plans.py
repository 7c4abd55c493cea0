"""Plans keep the shape they are meant to have."""

from __future__ import annotations

from pyspark.sql import functions as F

from silexa.operators import search, verify


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_vector_search_is_a_top_k_and_reads_what_it_needs(spark, tmp_path):
    rows = spark.range(50).select(F.col("id").alias("chunk_id"), F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>").alias("vector"), F.lit("t").alias("text"), F.lit("idf").alias("doc_type"))
    rows.write.partitionBy("doc_type").parquet(str(tmp_path / "s"))
    store = spark.read.parquet(str(tmp_path / "s"))
    plan = _plan(search.nearest(store, [1.0, 0.0], 5, search.Scope(doc_type="idf")).select("chunk_id", "distance"))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan and "text" not in plan.split("ReadSchema:")[1] and "PartitionFilters: [isnotnull(doc_type" in plan


def test_interleave_limits_before_the_shuffle(spark):
    rows = spark.range(10).select(F.col("id").alias("chunk_id"), (F.col("id") % 2).cast("string").alias("doc_type"), F.col("id").cast("string").alias("chip"), F.lit("").alias("file_path"), F.lit(0).alias("chunk_index"))
    assert "WindowGroupLimit" in _plan(search.interleaved(rows, 3))


def test_census_joins_are_equi_joins(spark):
    registers = spark.createDataFrame([("A", False, "c", "01")], "name string, parameterised boolean, chip string, chapter string")
    chunks = spark.createDataFrame([("c", "A")], "chip string, text string")
    plan = _plan(verify.cross_resolution(registers, spark.createDataFrame([("src", ["c"], ["A"])], "doc_type string, chips array<string>, symbol_refs array<string>")))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Cartesian" not in _plan(verify.census_check(registers, chunks))
