"""Parquet table source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of a data set, with its stored schema (column pruning and filters reach the scan)."""
    return spark.read.parquet(f"{root}/{name}.parquet")
