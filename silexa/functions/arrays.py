"""Column expressions on lists that hold each value once, in order of first sight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listed(values: Column) -> Column:
    """The list itself; null gives an empty one."""
    return F.coalesce(values, F.array().cast("array<string>"))


def ordered_union(*lists: Column) -> Column:
    """Values of all lists, each once, in order of first sight; nulls among them are dropped."""
    return F.array_compact(F.array_distinct(F.concat(*map(listed, lists))))


def contains_all(whole: Column, part: Column) -> Column:
    """Whether every value of ``part`` is in ``whole``."""
    return F.size(F.array_except(listed(part), listed(whole))) == 0


def in_order_union(rows: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """Per key the values of each list column over all rows, in order of first sight.

    Each value is reduced to its first place before lists are built, in the map side too, so that
    a key of very many rows costs no more than its distinct values.
    """
    out = None
    for c in columns:
        seen = rows.select(*keys, F.col(order).alias("_o"), F.posexplode(F.col(c)).alias("_p", "_v")).where(F.col("_v").isNotNull())
        first = seen.groupBy(*keys, "_v").agg(F.min(F.struct("_o", "_p")).alias("_at"))
        lists = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda s: s["_v"]).alias(c))
        out = lists if out is None else out.join(lists, keys, "full")
    return out
