"""Chunks as lines of JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())
RAW = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("text", "section_path")],
        *[T.StructField(c, _STRINGS) for c in ("file_refs", "doc_refs", "symbol_refs", "chips")],
        T.StructField("file_path", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("chip", T.StringType()),
        T.StructField("revisions", _STRINGS),
    ]
)


def read_jsonl(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of the files with a given schema, ``file_ord`` (place of the file in the list) and ``line_ord`` (order within a file).

    Lines that aren't JSON give rows of nulls, with the line in ``bad_line``.
    """
    schema = T.StructType([*RAW.fields, T.StructField("bad_line", T.StringType())])
    parts = []
    for k, path in enumerate(paths):
        rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", "bad_line").json(path)
        parts.append(rows.withColumn("file_ord", F.lit(k)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("line_ord", F.monotonically_increasing_id())


def write_jsonl(rows: DataFrame, path: str, *order: str) -> None:
    """One object per line; files are ranges of ``order``, and sorted."""
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
