"""Parquet tables of one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silexa.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the directory, a file or a folder of files; only the columns used are read."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
