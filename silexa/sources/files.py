"""Files of a folder as rows, and parsers applied to them; a file that can't be parsed is a row with an error."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silexa.session import ship
from silexa.sources.trees import CHUNKS

_LISTS = ("file_refs", "doc_refs", "symbol_refs")


def files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(name relative to the root, content) of all matching files below a folder, in parallel."""
    ship(spark)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    base = root.split("://")[-1].rstrip("/")
    relative = F.regexp_replace(F.col("path"), r"^[a-z0-9]+:(//[^/]*)?", "")
    return found.select(F.substring(relative, len(base) + 2, 1_000_000).alias("name"), "content")


def parsed(rows: DataFrame, parse: Callable[[str, bytes], list[dict]]) -> DataFrame:
    """Chunks that ``parse`` makes of (name, content). Errors of one file don't stop the others: see column ``error``."""
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    types = {"chunk_index": pa.int32()} | dict.fromkeys(_LISTS, pa.list_(pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    out = parse(name, content)
                except Exception as e:  # noqa: BLE001
                    out = [dict.fromkeys(names) | {"file_path": name, "error": f"{type(e).__name__}: {e}"[:500]}]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], types.get(c, pa.string())) for c in names], names=names)

    return rows.select("name", "content").mapInArrow(run, CHUNKS)


def good(chunks: DataFrame) -> DataFrame:
    return chunks.where("error IS NULL").drop("error")


def failures(chunks: DataFrame) -> DataFrame:
    return chunks.where("error IS NOT NULL").select("file_path", "error")
