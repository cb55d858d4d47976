"""How many tasks work that is heavy for its bytes gets."""

from __future__ import annotations

from pyspark.sql import DataFrame


def width(df: DataFrame) -> int:
    """The session's shuffle width. Given as a number, it is not lowered for small bytes."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over all cores, where the scan has fewer splits than there are cores.

    Only then are rows shuffled (such an input is small by definition); an input with many
    splits is left where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
