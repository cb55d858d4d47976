"""Counts of neighbouring values along ordered sequences, without sorting any sequence in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skysift.operators.ordered import ordered_ranges
from skysift.session import materialize

SCHEMA = "previous string, next string, n long, part int, first_key string, first_value string, last_key string, last_value string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[str, str], int] = {}
    first = last = None
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        key, value = b.column(0), b.column(3).dictionary_encode()
        names, code = value.dictionary.to_pylist(), value.indices.to_numpy(zero_copy_only=False)
        if first is None:
            first = (key[0].as_py(), names[code[0]])
        elif last[0] == key[0].as_py():
            pair = (last[1], names[code[0]])
            total[pair] = total.get(pair, 0) + 1
        last = (key[n - 1].as_py(), names[code[n - 1]])
        if n > 1:
            same = pc.equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
            both, count = np.unique(code[:-1][same].astype(np.int64) * len(names) + code[1:][same], return_counts=True)
            for x, c in zip(both.tolist(), count.tolist()):
                pair = (names[x // len(names)], names[x % len(names)])
                total[pair] = total.get(pair, 0) + c
    if first is None:
        return
    k, part = len(total), TaskContext.get().partitionId()
    text = lambda x: pa.array(x, pa.string())
    yield pa.RecordBatch.from_arrays(
        [text([*(p for p, _ in total), None]), text([*(q for _, q in total), None]), pa.array([*total.values(), 0], pa.int64()), pa.array([part] * (k + 1), pa.int32()), *(text([None] * k + [x]) for x in (*first, *last))],
        ["previous", "next", "n", "part", "first_key", "first_value", "last_key", "last_value"],
    )


def neighbour_counts(rows: DataFrame) -> DataFrame:
    """(previous, next, n) over ``rows(key, ts_us, tie, value)`` in the order (ts_us, tie) of each key.

    Sorted range partitions are scanned with the counts of the pairs in memory; a pair across
    a partition edge comes from one row per partition. Null keys, times or values are left out.
    """
    kept = rows.select("key", "ts_us", "tie", "value").where("key is not null and ts_us is not null and value is not null")
    found = materialize(ordered_ranges(kept, "key", "ts_us", "tie").mapInArrow(_scan, SCHEMA), "pairs")
    along = Window.orderBy("part")  # one row per partition
    edges = found.where("first_key is not null").withColumn("before_key", F.lag("last_key").over(along)).withColumn("previous", F.lag("last_value").over(along))
    across = edges.where("before_key = first_key").select("previous", F.col("first_value").alias("next"), F.lit(1).cast("long").alias("n"))
    return found.where("n > 0").select("previous", "next", "n").unionByName(across).groupBy("previous", "next").agg(F.sum("n").alias("n"))
