"""Upserts with a rule for each column, as a full outer join of table and folded batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Each rule gives the merged value of a column from (old, new). Spark's least and greatest
#: skip nulls, which is what the null-safe forms of the rules need.
RULES = {
    "overwrite": lambda old, new: new,
    "keep": lambda old, new: old,
    "coalesce_new": lambda old, new: F.coalesce(new, old),
    "least": lambda old, new: F.least(old, new),
    "greatest": lambda old, new: F.greatest(old, new),
    "add": lambda old, new: F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0)),
}


def newer_wins(value: str, time: str):
    """The value of the row whose ``time`` is later; at a tie the new one."""
    return lambda old, new: F.when(F.col(f"new.{time}") >= F.coalesce(F.col(f"old.{time}"), F.col(f"new.{time}")), new).otherwise(old)


def add_unless(same: str):
    """Added unless the batch mark ``same`` equals the stored one (a repeated batch)."""
    return lambda old, new: F.when(F.col(f"old.{same}").isNull() | (F.col(f"old.{same}") != F.col(f"new.{same}")), old + new).otherwise(old)


def merge_rows(table: DataFrame, batch: DataFrame, keys: list[str], rules: dict[str, str | object]) -> DataFrame:
    """``table`` with ``batch`` merged in by ``keys``; ``batch`` has one row a key.

    Columns without a rule are overwritten. Rows only in one side are kept as they are. Null
    keys match each other. One shuffle per side on the keys, none if they are co-located.
    """
    old, new = table.alias("old"), batch.alias("new")
    on = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    joined = old.withColumn("in_old", F.lit(True)).alias("old").join(new.withColumn("in_new", F.lit(True)).alias("new"), on, "full_outer")

    def merged(c: str) -> Column:
        o, n = F.col(f"old.{c}"), F.col(f"new.{c}")
        if c in keys:
            return F.when(F.col("in_old"), o).otherwise(n).alias(c)
        rule = rules.get(c, "overwrite")
        both = (RULES[rule] if isinstance(rule, str) else rule)(o, n)
        return F.when(F.col("in_old").isNull(), n).when(F.col("in_new").isNull(), o).otherwise(both).alias(c)

    return joined.select(*(merged(c) for c in table.columns))


def insert_only(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` and those rows of ``batch`` whose keys it does not hold, one a key."""
    fresh = batch.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti")
    return table.unionByName(fresh.select(*table.columns))
