"""The chunk store: one Parquet table partitioned by collection; every write can be repeated."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silexa.functions.arrays import in_order_union
from silexa.functions.symbols import documented_registers

_STRINGS = T.ArrayType(T.StringType())
CHUNK = T.StructType(
    [
        T.StructField("chunk_id", T.LongType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
        *[T.StructField(c, T.StringType()) for c in ("text", "source_doc", "doc_type", "chip")],
        *[T.StructField(c, _STRINGS) for c in ("chips", "revisions")],
        T.StructField("section_path", T.StringType()),
        *[T.StructField(c, _STRINGS) for c in ("file_refs", "doc_refs", "symbol_refs")],
        T.StructField("file_path", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        *[T.StructField(c, T.StringType()) for c in ("source_version", "source_commit")],
    ]
)
DOC_TYPES = ("idf", "src", "trm")


def checked(chunks: DataFrame) -> DataFrame:
    """The same rows; a doc_type outside the domain stops the job that meets it."""
    bad = F.raise_error(F.concat(F.lit("doc_type "), F.coalesce(F.col("doc_type"), F.lit("null"))))
    return chunks.withColumn("doc_type", F.when(F.col("doc_type").isin(*DOC_TYPES), F.col("doc_type")).otherwise(bad))


def write(chunks: DataFrame, path: str) -> None:
    """Writes the collections that the rows belong to; others in the table stay.

    Writing the same rows again leaves the same table: partitions are replaced, not appended to.
    """
    checked(chunks).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("doc_type").parquet(path)


def _text_key(*columns: Column) -> Column:
    """16 bytes for the values of the columns, nulls told from ''."""
    told = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\0", *told).cast("binary")))


def united(chunks: DataFrame, key: tuple[str, ...] = ("file_path", "text")) -> DataFrame:
    """One row per doc_type and key: rows that deliver a chunk again add their chips, revisions and refs.

    List columns become the union of all rows in order of chunk_id (and, among rows without one,
    of their content); the other columns are those of the first row in that order.
    """
    lists = [f.name for f in chunks.schema.fields if isinstance(f.dataType, T.ArrayType) and f.dataType.elementType == T.StringType() and f.name not in key]
    keyed = chunks.withColumn("_k", _text_key(F.col("doc_type"), *map(F.col, key)))
    keyed = keyed.withColumn("_at", F.struct(F.col("chunk_id").isNull().alias("n"), "chunk_id", F.xxhash64(*chunks.columns).alias("h")))
    repeated = keyed.groupBy("_k").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    both = keyed.join(repeated, "_k")
    once = both.where("_n = 1").select(*chunks.columns)
    several = both.where("_n > 1")
    merged = several.where(F.col("_at") == F.col("_first")).dropDuplicates(["_k"]).drop(*lists)
    sets = in_order_union(several, ["_k"], lists, "_at")
    return once.unionByName(merged.join(sets, "_k", "left").select(*chunks.columns))


def append(chunks: DataFrame, path: str, key: tuple[str, ...] = ("file_path", "text")) -> None:
    """Adds rows whose doc_type and key the table doesn't have; nulls in keys are equal.

    Rows of one key among the new ones are united (see ``united``), so what is stored doesn't depend
    on their order. Keys are compared as 16 bytes; of the table only they are shuffled. Where the
    table has the key, the row stays as it is.
    """
    spark = chunks.sparkSession
    fresh = united(chunks, key)
    try:
        have = spark.read.schema(chunks.schema).parquet(path).select(_text_key(F.col("doc_type"), *map(F.col, key)).alias("_k")).distinct()
        fresh = fresh.withColumn("_k", _text_key(F.col("doc_type"), *map(F.col, key))).join(have, "_k", "left_anti").drop("_k")
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
    checked(fresh).write.mode("append").partitionBy("doc_type").parquet(path)


def delete(spark: SparkSession, path: str, doc_type: str) -> int:
    """Deletes a collection from the table at ``path``; returns the number of its rows. One that isn't there has none."""
    if doc_type not in DOC_TYPES:
        raise ValueError(f"doc_type is one of {', '.join(DOC_TYPES)}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(f"{path.rstrip('/')}/doc_type={doc_type}")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return 0
    n = spark.read.schema(CHUNK).parquet(path).where(F.col("doc_type") == doc_type).count()
    files.delete(place, True)
    return n


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNK).parquet(path)


def without_collection(chunks: DataFrame, doc_type: str) -> DataFrame:
    """The table after a collection is deleted."""
    if doc_type not in DOC_TYPES:
        raise ValueError(f"doc_type is one of {', '.join(DOC_TYPES)}")
    return chunks.where(~F.col("doc_type").eqNullSafe(F.lit(doc_type)))


def with_constants(chunks: DataFrame, values: dict[str, Column], only: str | None = None) -> DataFrame:
    """Adds the columns that are missing, with constant values; existing ones stay.

    ``only`` names the one collection the table may hold: rows of another raise ValueError.
    """
    if only is not None and not chunks.where(~F.col("doc_type").eqNullSafe(F.lit(only))).isEmpty():
        raise ValueError(f"the table holds more than {only}")
    have = set(chunks.columns)
    return chunks.withColumns({c: v for c, v in values.items() if c not in have})


def with_refreshed_symbols(chunks: DataFrame, fresh: DataFrame) -> DataFrame:
    """symbol_refs from a fresh ingest where it has the chunk (file_path, text), else the registers that the text documents.

    A match counts even if its list is empty. Texts are compared as 16-byte keys.
    """
    key = F.unhex(F.md5(F.concat_ws("\0", F.coalesce("file_path", F.lit("")), F.coalesce("text", F.lit(""))).cast("binary")))
    told = fresh.select(key.alias("_k"), F.coalesce("symbol_refs", F.array().cast("array<string>")).alias("_s")).groupBy("_k").agg(F.min("_s").alias("_s"))
    both = chunks.withColumn("_k", key).join(told, "_k", "left")
    symbols = F.when(F.col("_s").isNotNull(), F.col("_s")).otherwise(documented_registers(F.col("text")))
    return both.withColumn("symbol_refs", symbols).drop("_k", "_s")


def replace(rows: DataFrame, path: str, dry_run: bool = False) -> int:
    """Replaces the table at ``path`` by ``rows``, which may be made from it; returns the number of rows.

    The new table is written beside the old one and counted; if the number of rows differs from
    the old table's, the new one is deleted and ValueError raised. Then the two are swapped by
    renaming. ``dry_run`` counts only.
    """
    spark = rows.sparkSession
    old = spark.read.parquet(path).count()
    if dry_run:
        return rows.count()
    side = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    rows.write.partitionBy("doc_type").parquet(side)
    new = spark.read.parquet(side).count()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if new != old:
        files.delete(hadoop.Path(side), True)
        raise ValueError(f"{old} rows became {new}")
    files.rename(hadoop.Path(path), hadoop.Path(f"{side}.old"))
    files.rename(hadoop.Path(side), hadoop.Path(path))
    files.delete(hadoop.Path(f"{side}.old"), True)
    return new
