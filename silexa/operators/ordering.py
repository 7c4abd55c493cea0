"""Running totals and positions in a total order, without gathering the rows, or those of one key, in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silexa.session import cut


def running_total(rows: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows up to each one in a total order.

    Rows are range-partitioned and added up within partitions; the sums of the partitions before
    are added. They are written once to the shared folder, so both steps see the same partitions.
    """
    parts = cut(rows.withColumn("_value", value).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = parts.groupBy("_part").agg(F.sum("_value").alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))  # one row per partition
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = parts.withColumn("_within", F.sum("_value").over(within)).join(F.broadcast(before), "_part")
    return out.withColumn(name, F.col("_within") + F.col("_before")).drop("_part", "_value", "_within", "_before")


def global_position(rows: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Adds 0, 1, 2, ... in a total order."""
    return running_total(rows, order, F.lit(1), name).withColumn(name, F.col(name) - 1)


def position_within(rows: DataFrame, key: str, order: list[Column], name: str = "position") -> DataFrame:
    """Adds 0, 1, 2, ... within each key; a key may hold most of the rows."""
    placed = global_position(rows, [F.col(key), *order], "_at")
    firsts = placed.groupBy(key).agg(F.min("_at").alias("_first")).withColumnRenamed(key, "_key")
    return placed.join(firsts, F.col(key).eqNullSafe(F.col("_key"))).withColumn(name, (F.col("_at") - F.col("_first")).cast("int")).drop("_at", "_first", "_key")
