"""Readers of the tables in a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table `name` of `folder`. Only the columns used later are read, and filters reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
