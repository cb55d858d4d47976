"""Matching rows against patterns whose null columns match everything."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _masks(patterns: DataFrame, columns: list[str]) -> Iterator[tuple[list[str], DataFrame]]:
    """Patterns by which columns they name, with those columns.

    Which combinations occur is asked once: there are at most 2 ** len(columns).
    """
    named = F.concat(*(F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns))
    for (mask,) in patterns.select(named.alias("mask")).distinct().collect():
        yield [c for c, m in zip(columns, mask) if m == "1"], patterns.where(named == mask)


def null_tolerant_anti(rows: DataFrame, patterns: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that no pattern matches. A null in a row matches only a null in the pattern.

    One anti-join on equality for each combination of named columns, never a comparison of all
    rows with all patterns. A pattern that names nothing matches every row.
    """
    patterns, order = patterns.select(*columns).distinct(), rows.columns
    for named, part in _masks(patterns, columns):
        rows = rows.join(part.select(*named), named, "left_anti").select(*order) if named else rows.where("false")
    return rows


def single_match(rows: DataFrame, patterns: DataFrame, columns: list[str], value: str) -> DataFrame:
    """Different rows (their ``columns``) matched by exactly one pattern, with its ``value``."""
    rows, patterns = rows.select(*columns).distinct(), patterns.select(*columns, value)
    hits = None
    for named, part in _masks(patterns, columns):
        folded = [F.max(value).alias(value), F.count("*").alias("n")]
        if named:
            one = rows.join(part.groupBy(*named).agg(*folded), named)
        else:
            every = part.agg(*folded).first()  # one row, whatever the patterns
            one = rows.withColumn(value, F.lit(every[0])).withColumn("n", F.lit(every[1]).cast("long"))
        one = one.select(*columns, value, "n")
        hits = one if hits is None else hits.unionByName(one)
    if hits is None:
        return rows.withColumn(value, F.lit(None).cast(patterns.schema[value].dataType)).where("false")
    return hits.groupBy(*columns).agg(F.max(value).alias(value), F.sum("n").alias("n")).where("n = 1").drop("n")
