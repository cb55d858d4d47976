"""Problem 1: spikes, stuck values and impossible readings along each sensor's time line."""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skysift.functions.mac import epoch_us
from skysift.operators.ordered import ordered_ranges
from skysift.operators.spread import width
from skysift.session import materialize

BUCKET_US = 30 * 60 * 1_000_000
PER_DAY = 48
#: Power in dBm that a receiver can report lies strictly between these.
LOWEST, HIGHEST = -120, 0
#: Buckets of one fitted block and of its overlap on either side (28 and 7 days).
BLOCK, HALO = 28 * PER_DAY, 7 * PER_DAY
#: Readings pooled for one local level.
POOL = 25
#: Shorter runs are never looked at; every sensor's own limit is at least this.
LEAST_RUN = 6
MODEL = "sensor_id string, bucket long, value int, residual int, n long"


def weighted_median(x: np.ndarray, w: np.ndarray) -> float:
    order = np.argsort(x, kind="stable")
    c = np.cumsum(w[order])
    i = np.searchsorted(c, c[-1] / 2)
    j = np.searchsorted(c, c[-1] / 2, side="right")
    return (x[order[i]] + x[order[min(j, len(x) - 1)]]) / 2


def decompose(bucket: np.ndarray, value: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Robust seasonal-trend decomposition of a histogram sorted by bucket.

    Returns each cell's residual and the bucket starts. Season: median over days by time of
    day. Trend: running median of what the season leaves, pooled over at least POOL readings.
    A reading is measured against the level of its own bucket and of both neighbours and
    keeps the least residual, so that a lasting change of level inside a bucket is no outlier.
    """
    grid, first = np.unique(bucket, return_index=True)
    last = np.append(first[1:], len(bucket))
    weight = np.add.reduceat(count, first)
    phase = (grid % PER_DAY).astype(int)
    middle = np.array([weighted_median(value[a:b].astype(float), count[a:b]) for a, b in zip(first, last)])
    season = np.zeros(PER_DAY)
    for _ in range(2):
        rest = middle - season[phase]
        lo, hi = np.searchsorted(grid, grid - PER_DAY // 2), np.searchsorted(grid, grid + PER_DAY // 2, side="right")
        trend = np.array([np.median(rest[a:b]) for a, b in zip(lo, hi)])
        off = middle - trend
        raw = np.zeros(PER_DAY)
        for p in range(PER_DAY):
            near = np.isin(phase, [(p - 1) % PER_DAY, p, (p + 1) % PER_DAY])
            raw[p] = weighted_median(off[near], weight[near]) if near.any() else 0.0
        season = (np.roll(raw, 1) + raw + np.roll(raw, -1)) / 3
    flat = value - season[(bucket % PER_DAY).astype(int)]
    total = np.concatenate([[0], np.cumsum(weight)])
    level = np.empty(len(grid))
    for i in range(len(grid)):
        a, b = i, i + 1
        while total[b] - total[a] < POOL and (a > 0 or b < len(grid)):
            a, b = max(0, a - 1), min(len(grid), b + 1)
        level[i] = weighted_median(flat[first[a] : last[b - 1]], count[first[a] : last[b - 1]])
    own = np.repeat(np.arange(len(grid)), last - first)
    choices = np.stack([flat - level[np.clip(own + k, 0, len(grid) - 1)] for k in (0, -1, 1)])
    return choices[np.abs(choices).argmin(0), np.arange(len(flat))], first


def esd_outliers(residual: np.ndarray, count: np.ndarray, alpha: float = 1e-3, step: float = 1.0) -> np.ndarray:
    """Generalised extreme studentised deviate test on weighted values: a mask of the outliers.

    Values are taken off by distance from the median while those left are the greater half:
    many outliers hide each other until most of them are off, so the test does not stop where
    it finds none. The last one whose studentised deviate among those left exceeds the
    critical value marks it and all taken before it. Equal readings of a cell go one by one and
    the last of them decides. ``step`` is the receiver's resolution, below which nothing is far.
    """
    out = np.zeros(len(residual), bool)
    n = int(count.sum())
    if n < 10:
        return out
    order = np.argsort(np.abs(residual - weighted_median(residual, count)), kind="stable")
    r, w = residual[order], count[order].astype(float)
    # what is left when one reading of the cell remains
    left, total, square = (np.cumsum(x) - x + x / w for x in (w, w * r, w * r * r))
    mean = total / left
    sd = np.sqrt(np.maximum((square - left * mean * mean) / np.maximum(left - 1, 1), 1e-12))
    found = 0
    for i in range(len(r) - 1, -1, -1):
        m = left[i]
        if 2 * (m - 1) <= n or m < 10:
            break
        z = NormalDist().inv_cdf(1 - alpha / (2 * m))
        v = m - 2
        t = z + (z**3 + z) / (4 * v) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * v * v)
        if abs(r[i] - mean[i]) / max(sd[i], 0.3 * step) > (m - 1) * t / math.sqrt((v + t * t) * m):
            found = len(r) - i
    if found:
        out[order[len(r) - found :]] = True
    return out


def resolution(value: np.ndarray, count: np.ndarray) -> float:
    """The usual step between values that at least a hundredth of the readings have, 1 to 3 dB."""
    level, at = np.unique(value, return_inverse=True)
    n = np.bincount(at, weights=count)
    common = n >= 0.01 * n.sum()
    level, n = level[common], n[common]
    if len(level) < 2:
        return 1.0
    gap = np.diff(level).astype(float)
    return min(max(weighted_median(np.minimum(np.append(gap, np.inf), np.append(np.inf, gap)), n), 1.0), 3.0)


def run_limit(residual: np.ndarray, count: np.ndarray, alpha: float = 1e-3) -> int:
    """The run length that chance repeats of this sensor's noise do not reach."""
    _, at = np.unique(np.rint(residual), return_inverse=True)
    p = np.bincount(at, weights=count) / count.sum()
    same = min(max(float((p * p).sum()), 0.02), 0.9)
    return max(LEAST_RUN, 2 + math.ceil(math.log(alpha / max(count.sum(), 1)) / math.log(same)))


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """Outlying cells of a block's own buckets, then (bucket null) the counts of its own residuals."""
    pdf = pdf.sort_values(["bucket", "value"])
    bucket, value, count = (pdf[c].to_numpy() for c in ("bucket", "value", "n"))
    own = bucket // BLOCK == pdf["block"].iloc[0]
    if not own.any():
        return pd.DataFrame(columns=["sensor_id", "bucket", "value", "residual", "n"])
    residual, _ = decompose(bucket, value, count)
    bad = esd_outliers(residual, count, step=resolution(value, count)) & own
    sensor = pdf["sensor_id"].iloc[0]
    cells = pd.DataFrame({"sensor_id": sensor, "bucket": bucket[bad], "value": value[bad], "residual": None, "n": None})
    noise = pd.DataFrame({"residual": np.rint(residual[own]), "n": count[own]}).groupby("residual", as_index=False)["n"].sum()
    noise = noise.assign(sensor_id=sensor, bucket=None, value=None)
    return pd.concat([cells, noise]).astype({"bucket": "Int64", "value": "Int32", "residual": "Int32", "n": "Int64"})


def _limit(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"sensor_id": pdf["sensor_id"].iloc[:1], "run_limit": run_limit(pdf["residual"].to_numpy(), pdf["n"].to_numpy())})


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flagged rows, and all rows of runs of equal values that are long or touch the edge of a batch or partition."""
    part = TaskContext.get().partitionId()
    names = ["sensor_id", "dedupe_key", "value", "impossible", "spike", "part", "run", "whole"]
    last, run = None, -1
    for b in batches:
        if not b.num_rows:
            continue
        sensor, ts, key, value = b.column(0), b.column(1).to_numpy(zero_copy_only=False), b.column(2), b.column(3).to_numpy(zero_copy_only=False)
        n = b.num_rows
        new_sensor, again = np.ones(n, bool), np.zeros(n, bool)
        new_sensor[1:] = pc.not_equal(sensor[1:], sensor[:-1]).to_numpy(zero_copy_only=False)
        again[1:] = ~new_sensor[1:] & (ts[1:] == ts[:-1]) & pc.fill_null(pc.equal(key[1:], key[:-1]), False).to_numpy(zero_copy_only=False)
        if last is not None:
            new_sensor[0] = sensor[0].as_py() != last[0]
            again[0] = not new_sensor[0] and ts[0] == last[1] and key[0].as_py() is not None and key[0].as_py() == last[2]
        keep = np.flatnonzero(~again)
        last_value = last[3] if last is not None else None
        last = (sensor[n - 1].as_py(), int(ts[n - 1]), key[n - 1].as_py(), int(value[n - 1]))
        if not len(keep):
            continue
        v = value[keep]
        # a sensor's first kept row never is a repeat, so the change of sensor survives
        start = new_sensor[keep].copy()
        start[1:] |= v[1:] != v[:-1]
        start[0] |= last_value is None or v[0] != last_value
        number = run + np.cumsum(start)
        fresh = np.flatnonzero(new_sensor[keep])
        _, begin, size = np.unique(number, return_index=True, return_counts=True)
        long_ = size >= LEAST_RUN
        long_[0] = long_[-1] = True
        # a sensor's first and last run in a partition may continue in the neighbour
        heads = np.searchsorted(begin, fresh)
        long_[heads] = True
        long_[np.maximum(heads - 1, 0)] = True
        whole = np.repeat(long_, size)
        run = int(number[-1])
        kept = b.take(pa.array(keep))
        at = pa.array(whole | kept.column(4).to_numpy(zero_copy_only=False) | kept.column(5).to_numpy(zero_copy_only=False))
        rows = [c.filter(at) for c in (kept.column(0), kept.column(2), *kept.columns[3:], pa.array(np.full(len(keep), part, np.int32)), pa.array(number, pa.int64()), pa.array(whole))]
        yield pa.RecordBatch.from_arrays(rows, names)


def flagged_rows(readings: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows of ``readings(sensor_id, ts_us, dedupe_key, value, impossible, spike)`` with a flag, stuck included.

    Stuck are runs of one value at least ``limits.run_limit`` long. Order comes from range
    partitions, so a sensor with most of the rows is spread over many tasks. Runs cut by a
    partition edge are joined from one row per run and partition.
    """
    schema = "sensor_id string, dedupe_key string, value int, impossible boolean, spike boolean, part int, run long, whole boolean"
    rows = materialize(ordered_ranges(readings, "sensor_id", "ts_us", "dedupe_key").mapInArrow(_runs, schema), "runs")
    pieces = rows.where("whole").groupBy("sensor_id", "part", "run", "value").agg(F.count("*").alias("n"))
    by_part = Window.partitionBy("sensor_id", "part")
    pieces = pieces.withColumn("tail", F.col("run") == F.max("run").over(by_part)).withColumn("head", F.col("run") == F.min("run").over(by_part))
    edges = pieces.where("head or tail")
    along = Window.partitionBy("sensor_id").orderBy("part", "run")
    joins = F.col("head") & F.lag("tail").over(along) & (F.lag("part").over(along) < F.col("part")) & (F.lag("value").over(along) == F.col("value"))
    chained = edges.withColumn("chain", F.sum(F.when(joins, 0).otherwise(1)).over(along))
    chained = chained.withColumn("total", F.sum("n").over(Window.partitionBy("sensor_id", "chain"))).select("sensor_id", "part", "run", "total")
    inner = pieces.where("not (head or tail)").select("sensor_id", "part", "run", F.col("n").alias("total"))
    long_ = inner.unionByName(chained).where(F.col("total") >= LEAST_RUN).join(limits, "sensor_id").where("total >= run_limit").select("sensor_id", "part", "run", F.lit(True).alias("stuck"))
    marked = rows.join(long_, ["sensor_id", "part", "run"], "left").withColumn("stuck", F.coalesce("stuck", F.lit(False)))
    return marked.where("stuck or impossible or spike")


def signal_anomalies(frames: DataFrame) -> DataFrame:
    """Flagged readings of projection frames, one row per frame with at least one flag.

    Columns: dedupe_key, sensor_id, impossible, stuck, spike (int 0/1).

    impossible: outside the open range (LOWEST, HIGHEST) dBm. spike: residual of the robust
    seasonal-trend decomposition beyond the extreme-studentised-deviate limit of its sensor.
    stuck: a run of one value longer than chance repeats of the sensor's own noise.

    The decomposition works on counts by (sensor, half hour, value), combined before the
    shuffle; their number does not depend on the number of readings. Each sensor is fitted in
    blocks of 28 days with 7 days of overlap, so no task sees an unbounded group. The noise of
    a sensor is pooled over its blocks, each without its overlap: every reading counts once.

    Null sensor, signal, time or key: no reading. Repeated frames (equal key and time) count
    once in runs. Fewer than 10 readings in a block: no spikes. Empty input: no rows.
    """
    readings = frames.select(
        "sensor_id", "dedupe_key", epoch_us(F.col("observed_at")).alias("ts_us"), F.col("signal_dbm").cast("int").alias("value")
    ).where("sensor_id is not null and dedupe_key is not null and ts_us is not null and value is not null")
    bucket = F.floor(F.col("ts_us") / F.lit(BUCKET_US)).cast("long")
    possible = (F.col("value") > LOWEST) & (F.col("value") < HIGHEST)
    cells = readings.where(possible).groupBy("sensor_id", bucket.alias("bucket"), "value").agg(F.count("*").alias("n"))
    near = F.array_distinct(F.array(*(F.floor((F.col("bucket") + d) / BLOCK).cast("long") for d in (-HALO, 0, HALO))))
    model = materialize(cells.withColumn("block", F.explode(near)).repartition(width(frames), "sensor_id", "block").groupBy("sensor_id", "block").applyInPandas(_fit, MODEL), "signal-model")
    noise = model.where("bucket is null").groupBy("sensor_id", "residual").agg(F.sum("n").alias("n"))
    limits = noise.groupBy("sensor_id").applyInPandas(_limit, "sensor_id string, run_limit int")
    spikes = model.where("bucket is not null").select("sensor_id", "bucket", "value", F.lit(True).alias("spike"))
    marked = readings.withColumn("bucket", bucket).join(spikes, ["sensor_id", "bucket", "value"], "left")
    marked = marked.select("sensor_id", "ts_us", "dedupe_key", "value", (~possible).alias("impossible"), F.coalesce("spike", F.lit(False)).alias("spike"))
    flags = flagged_rows(marked, limits)
    return flags.groupBy("dedupe_key").agg(F.min("sensor_id").alias("sensor_id"), *(F.max(F.col(c).cast("int")).alias(c) for c in ("impossible", "stuck", "spike")))
