"""Problem 5: split each source's events into sessions at inactivity gaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skysift.functions.mac import canonical_mac, epoch_us
from skysift.operators.ordered import ordered_ranges
from skysift.session import materialize

SCHEMA = "source string, start_us long, end_us long, events long, edge boolean"


def _scan(gap_us: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None  # source, start, end, events, last key: all that is kept between batches
        first = True

        def out(source, start, end, events, edge):
            arrays = [pa.array(source, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(events, pa.int64()), pa.array(edge, pa.bool_())]
            return pa.RecordBatch.from_arrays(arrays, ["source", "start_us", "end_us", "events", "edge"])

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            src, ts, key = b.column(0), b.column(1).to_numpy(zero_copy_only=False), b.column(2)
            other, again = np.ones(n, bool), np.zeros(n, bool)
            if n > 1:
                other[1:] = pc.not_equal(src[1:], src[:-1]).to_numpy(zero_copy_only=False)
                again[1:] = ~other[1:] & (ts[1:] == ts[:-1]) & pc.fill_null(pc.equal(key[1:], key[:-1]), False).to_numpy(zero_copy_only=False)
            starts = other.copy()
            starts[1:] |= ts[1:] - ts[:-1] > gap_us
            if open_ is not None and src[0].as_py() == open_[0]:
                starts[0] = ts[0] - open_[2] > gap_us
                again[0] = ts[0] == open_[2] and key[0].as_py() is not None and key[0].as_py() == open_[4]
            events = np.concatenate([[0], np.cumsum(~again)])
            at = np.flatnonzero(starts)
            head = int(at[0]) if len(at) else n
            if open_ is not None and head:
                open_ = (open_[0], open_[1], int(ts[head - 1]), open_[3] + int(events[head]), open_[4])
            if len(at):
                if open_ is not None:
                    yield out([open_[0]], [open_[1]], [open_[2]], [open_[3]], [first])
                    first = False
                ends = np.append(at[1:], n)
                if len(at) > 1:
                    edge = np.zeros(len(at) - 1, bool)
                    edge[0], first = first, False
                    yield out(src.take(pa.array(at[:-1])), ts[at[:-1]], ts[ends[:-1] - 1], (events[ends] - events[at])[:-1], edge)
                a = int(at[-1])
                open_ = (src[a].as_py(), int(ts[a]), int(ts[n - 1]), int(events[n] - events[a]), None)
            open_ = (*open_[:4], key[n - 1].as_py())
        if open_ is not None:
            yield out([open_[0]], [open_[1]], [open_[2]], [open_[3]], [True])

    return run


def sessionize(events: DataFrame, gap_us: int) -> DataFrame:
    """Sessions of ``events(source string, ts_us long, event_key string)``.

    Secondary sort by (source, time, key) over range partitions, then one linear scan per
    partition that keeps only the open session (constant memory, however active a source
    is). Each partition's first and last session may continue in a neighbour; these at most
    two rows per partition are joined by a second, tiny step.

    A new session starts when more than ``gap_us`` passed since the source's last event.
    Rows equal in source, time and key are one event; rows with a null key are events of
    their own. Null sources or times are left out. Empty input gives no rows.
    Returns source, start_us, end_us, duration_us, events.
    """
    kept = events.select("source", "ts_us", "event_key").where("source is not null and ts_us is not null")
    parts = materialize(ordered_ranges(kept, "source", "ts_us", "event_key").mapInArrow(_scan(gap_us), SCHEMA), "sessions")
    along = Window.partitionBy("source").orderBy("start_us", "end_us")
    cut = F.when(F.col("start_us") - F.lag("end_us").over(along) > gap_us, 1).otherwise(0)
    joined = (
        parts.where("edge")
        .withColumn("cut", cut)
        .withColumn("part", F.sum("cut").over(along))
        .groupBy("source", "part")
        .agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("events").alias("events"))
        .drop("part")
    )
    return parts.where("not edge").drop("edge").unionByName(joined).select("source", "start_us", "end_us", (F.col("end_us") - F.col("start_us")).alias("duration_us"), "events")


def frame_sessions(frames: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Sessions of the canonical source_mac of projection frames: frames of one dedupe_key count once."""
    events = frames.select(canonical_mac(F.col("source_mac")).alias("source"), epoch_us(F.col("observed_at")).alias("ts_us"), F.col("dedupe_key").alias("event_key"))
    return sessionize(events, gap_minutes * 60_000_000)
