"""Exact duplicates: one row per page and text, with all that its copies apply to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silexa.functions.arrays import in_order_union, listed

REFS = ["file_refs", "doc_refs", "symbol_refs"]


def _keyed(chunks: DataFrame, *parts: str) -> DataFrame:
    """Adds a 16-byte key, so that texts don't travel with every aggregate."""
    tagged = [F.concat(F.col(p).isNull().cast("string"), F.coalesce(p, F.lit("")), F.lit("\0")) for p in parts]
    return chunks.withColumn("_key", F.unhex(F.md5(F.concat(*tagged).cast("binary"))))


def dedup_targets(chunks: DataFrame, order: str = "raw_id") -> DataFrame:
    """Rows of one (file_path, text) as one: chips united and sorted, refs united in order of first sight, the smallest chunk_index, the first section_path.

    ``first_seen`` is the order of its first row. Nothing is fuzzy. Null paths and texts are
    values like others; null lists are empty; ``copies`` counts the rows.
    """
    rows = _keyed(chunks.select(order, "file_path", "text", "section_path", "chunk_index", "chips", *REFS), "file_path", "text")
    heads = rows.groupBy("_key").agg(F.min(order).alias("first_seen"), F.min("chunk_index").alias("chunk_index"), F.count("*").alias("copies"))
    refs = in_order_union(rows, ["_key"], REFS, order)
    chips = rows.select("_key", F.explode("chips").alias("c")).where("c IS NOT NULL").distinct().groupBy("_key").agg(F.array_sort(F.collect_list("c")).alias("chips"))
    first = rows.select(F.col(order).alias("first_seen"), "file_path", "text", "section_path")
    out = heads.join(chips, "_key", "left").join(refs, "_key", "left").join(first, "first_seen")
    return out.select("first_seen", "file_path", "text", "section_path", "chunk_index", "copies", listed(F.col("chips")).alias("chips"), *[listed(F.col(c)).alias(c) for c in REFS])


def dedup_revisions(chunks: DataFrame, order: str = "raw_id") -> DataFrame:
    """Rows of one (chip, file_path, text) as one: revisions united and sorted, position and refs of the first revision.

    Unlike ``dedup_targets`` nothing else is united: chunk_index and refs are those of the first
    row under the smallest revision label. Rows without a revision are left out.
    """
    rows = _keyed(chunks.select(order, "chip", "file_path", "text", "section_path", "chunk_index", "revisions", *REFS), "chip", "file_path", "text")
    labels = rows.select("_key", order, F.explode("revisions").alias("revision")).where("revision IS NOT NULL")
    first = labels.groupBy("_key").agg(F.min(F.struct("revision", order)).alias("first"))
    every = labels.select("_key", "revision").distinct().groupBy("_key").agg(F.array_sort(F.collect_list("revision")).alias("revisions"))
    picked = first.join(every, "_key").select(F.col(f"first.{order}").alias(order), F.col("first.revision").alias("first_revision"), "revisions")
    return picked.join(rows.drop("_key", "revisions"), order).select(F.col(order).alias("first_seen"), "chip", "file_path", "text", "section_path", "chunk_index", "first_revision", "revisions", *[listed(F.col(c)).alias(c) for c in REFS])


def spread(deduped: DataFrame, column: str = "chips") -> DataFrame:
    """How many rows apply to how many values of a list."""
    return deduped.groupBy(F.size(column).alias("values")).agg(F.count("*").alias("rows"))


def collapse(deduped: DataFrame) -> DataFrame:
    """Rows before and after, and the share that went."""
    read, kept = F.sum("copies"), F.count("*")
    return deduped.agg(read.alias("rows_read"), kept.alias("rows_kept"), F.round(100 * (1 - kept / F.greatest(read, F.lit(1))), 4).alias("collapsed_percent"))
