"""Chunks that arrive as JSONL files, added to the store as they come; windows over event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from silexa.operators import store


def stream_into_store(spark: SparkSession, folder: str, path: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Starts a query that reads new JSONL files of chunks and adds the rows whose (file_path, text) the store lacks.

    A batch that runs again after a failure adds nothing twice. It ends when all files are read.
    """
    rows = spark.readStream.schema(store.CHUNK).option("maxFilesPerTrigger", files_per_batch).json(folder)
    return rows.writeStream.foreachBatch(lambda batch, _: store.append(batch, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str, keys: list[str], width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts by tumbling or sliding window and key; events later than ``late`` behind the newest are dropped by streams."""
    span = F.window(time, width, slide) if slide else F.window(time, width)
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(span.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Runs of events of a key with no pause longer than ``gap``."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")
