"""Problem 6: mergeable percentiles (merging centroid digests with certified rank error)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift.functions.mac import epoch_us
from skysift.operators.ordered import ordered_ranges
from skysift.operators.spread import width
from skysift.session import materialize

#: Scale of the size function; a digest holds at most about half as many centroids.
DELTA = 1000
METRICS = ("tsft_delta_us", "wall_clock_delta_ms")
PCTS = (50, 95)


#: A digest: centroid means in order, weights, and which centroids stand for one value only.
Digest = tuple[np.ndarray, np.ndarray, np.ndarray]


def of_values(values: np.ndarray) -> Digest:
    mean, weight = np.unique(values, return_counts=True)
    return cluster(mean, weight.astype(float), np.ones(len(mean), bool))


def cluster(mean: np.ndarray, weight: np.ndarray, pure: np.ndarray, delta: int = DELTA) -> Digest:
    """Re-cluster sorted centroids: one cluster spans at most 1 on the arcsine scale.

    The scale is steep at both ends, so clusters there are small and extreme percentiles are
    exact or nearly so. Few values, and values that repeat a lot, keep centroids of their own.
    """
    same = np.append(False, (mean[1:] == mean[:-1]) & pure[1:] & pure[:-1])
    if same.any():
        at = np.flatnonzero(~same)
        mean, weight, pure = mean[at], np.add.reduceat(weight, at), pure[at]
    if len(mean) <= delta // 2:
        return mean, weight, pure
    total = np.cumsum(weight)
    q = (total - weight / 2) / total[-1]
    k = np.floor(delta / (2 * math.pi) * (np.arcsin(2 * q - 1) + math.pi / 2)).astype(np.int64)
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    w = np.add.reduceat(weight, at)
    alone = np.diff(np.append(at, len(mean))) == 1
    return np.add.reduceat(mean * weight, at) / w, w, alone & pure[at]


def merge(parts: list[Digest]) -> Digest:
    mean, weight, pure = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.argsort(mean, kind="stable")
    return cluster(mean[order], weight[order], pure[order].astype(bool))


def quantile(mean: np.ndarray, weight: np.ndarray, pure: np.ndarray, p: float) -> float:
    """Linear interpolation at rank p * (n - 1).

    A centroid of one value covers all its ranks, another stands at its middle rank. Exact,
    and equal to the usual interpolated percentile, while all centroids are of one value.
    """
    end = np.cumsum(weight)
    first, last = end - weight, end - 1
    middle = (first + last) / 2
    ranks = np.stack([np.where(pure, first, middle), np.where(pure, last, middle)], axis=1).ravel()
    return float(np.interp(p * (end[-1] - 1), ranks, np.repeat(mean, 2)))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop frames equal to the one before in sensor, time and key."""
    last = None
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        same = np.zeros(n, bool)
        if n > 1:
            same[1:] = pc.equal(b.column(0)[1:], b.column(0)[:-1]).to_numpy(zero_copy_only=False)
            same[1:] &= pc.equal(b.column(1)[1:], b.column(1)[:-1]).to_numpy(zero_copy_only=False)
            same[1:] &= pc.fill_null(pc.equal(b.column(2)[1:], b.column(2)[:-1]), False).to_numpy(zero_copy_only=False)
        same[0] = last is not None and last[2] is not None and last == tuple(b.column(i)[0].as_py() for i in range(3))
        last = tuple(b.column(i)[n - 1].as_py() for i in range(3))
        b = b.filter(pa.array(~same))
        yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[3:]], ["source", "day", *METRICS])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per group and stretch of rows; rows come sorted, so one group is open."""
    names = ["source", "day", "metric", "mean", "weight", "pure"]
    open_, held = None, [[] for _ in METRICS]

    def close():
        for metric, parts in zip(METRICS, held):
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array([open_[0]]), pa.array([open_[1]]), pa.array([metric]), *(pa.array([x]) for x in merge(parts))], names)

    for b in batches:
        n = b.num_rows
        if not n:
            continue
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = pc.or_(pc.not_equal(b.column(0)[1:], b.column(0)[:-1]), pc.not_equal(b.column(1)[1:], b.column(1)[:-1])).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        for a, z in zip(starts, np.append(starts[1:], n)):
            key = (b.column(0)[int(a)].as_py(), b.column(1)[int(a)].as_py())
            if key != open_:
                yield from close()
                open_, held = key, [[] for _ in METRICS]
            for i in range(len(METRICS)):
                v = b.column(2 + i)[int(a) : int(z)].drop_null().to_numpy(zero_copy_only=False).astype(float)
                if len(v):
                    held[i].append(of_values(v))
                    if len(held[i]) > 16:
                        held[i] = [merge(held[i])]
    yield from close()


def bracket(mean: np.ndarray, weight: np.ndarray, pure: np.ndarray, p: float) -> tuple[float, float]:
    """Values that the p-quantile should lie between: those of its ranks if all centroids are exact, else the next centroids."""
    rank = p * (weight.sum() - 1)
    end = np.cumsum(weight)
    a, b = (min(int(np.searchsorted(end, r, side="right")), len(mean) - 1) for r in (math.floor(rank + 1e-9), math.ceil(rank - 1e-9)))
    if pure.all():
        return float(mean[a]), float(mean[b])
    return float(mean[max(a - 1, 0)]), float(mean[min(b + 1, len(mean) - 1)])


def _combine(pdf: pd.DataFrame) -> pd.DataFrame:
    """Percentiles, with brackets, of each day and of all days of one source and metric."""
    rows, everything = [], []
    for day, part in pdf.groupby("day"):
        d = merge(list(zip(part["mean"], part["weight"], part["pure"])))
        everything.append(d)
        rows.append((day, d[1].sum(), *(x for p in PCTS for x in (quantile(*d, p / 100), *bracket(*d, p / 100)))))
    whole = merge(everything)
    out = pd.DataFrame(rows, columns=["day", "n", *(f"{c}_day{p}" for p in PCTS for c in ("at", "lo", "hi"))])
    for p in PCTS:
        out[f"at_all{p}"] = quantile(*whole, p / 100)
        out[f"lo_all{p}"], out[f"hi_all{p}"] = bracket(*whole, p / 100)
    out.insert(0, "metric", pdf["metric"].iloc[0])
    out.insert(0, "source", pdf["source"].iloc[0])
    return out.astype({"n": "int64"})


def clean_values(frames: DataFrame) -> DataFrame:
    """(source, day, metrics...) of projection frames, each frame once, sorted, written once."""
    rows = frames.select(
        F.col("sensor_id").alias("source"), epoch_us(F.col("observed_at")).alias("ts_us"), F.col("dedupe_key").alias("key"),
        F.date_format(F.col("observed_at").cast("timestamp"), "yyyy-MM-dd").alias("day"), *(F.col(m).cast("double") for m in METRICS),
    ).where("source is not null and ts_us is not null")
    schema = "source string, day string, " + ", ".join(f"{m} double" for m in METRICS)
    return materialize(ordered_ranges(rows, "source", "ts_us", "key").mapInArrow(_clean, schema), "values")


RANKS = [f"{scope}{p}" for scope in ("day", "all") for p in PCTS]


def day_percentiles(values: DataFrame) -> DataFrame:
    """Percentiles by source, day and metric, and over all of a source's days.

    Columns: source, metric, day, n and, for day and all days and each percentage, the estimate
    (``at_``) and a bracket (``lo_``, ``hi_``). Digests of stretches are merged to days and days
    to the whole, so results of other partitions or days can be added. Groups are contiguous
    stretches of range partitions: a hot source is spread over many tasks, and what is merged
    is one digest per stretch. Null values do not count.
    """
    schema = "source string, day string, metric string, mean array<double>, weight array<double>, pure array<boolean>"
    out = "source string, metric string, day string, n long, " + ", ".join(f"{c}_{r} double" for r in RANKS for c in ("at", "lo", "hi"))
    return values.mapInArrow(_digests, schema).repartition(width(values), "source", "metric").groupBy("source", "metric").applyInPandas(_combine, out)


def _long(values: DataFrame) -> DataFrame:
    """(source, day, metric, x): one row for each value that is not null."""
    each = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("x")) for m in METRICS))
    return values.select("source", "day", F.explode(each).alias("v")).select("source", "day", "v.metric", "v.x").where("x is not null")


def certified(values: DataFrame, estimates: DataFrame) -> DataFrame:
    """Long form (source, day, metric, pct, n, value, whole, ...) with certificates.

    One second pass counts how many values lie below and up to each estimate and each end of
    its bracket; the counts of a source's days add up to those of the whole. rank_error and
    whole_rank_error are the distances of the wanted rank from the estimate's counts, as
    shares of n. least and most bound the exact (interpolated) percentile, whole_least and
    whole_most that of all days: they are equal where the counts prove the ends of the bracket
    to be the wanted ranks, the bracket where they prove these to lie in it, else the least
    and greatest value. below and whole_below are how many values are less than those bounds.
    Certificates hold whatever the distribution.
    """
    keys = ["source", "metric", "day"]
    x = F.col("x")
    sums = [F.sum(test(x, F.col(f"{end}_{r}")).cast("long")).alias(f"{name}_{end}_{r}") for r in RANKS for end in ("at", "lo", "hi") for name, test in (("lt", lambda a, b: a < b), ("le", lambda a, b: a <= b))]
    counts = _long(values).join(estimates.drop("n"), keys).groupBy(*keys).agg(F.count("*").alias("n"), F.min("x").alias("min"), F.max("x").alias("max"), *sums)
    counts = materialize(counts, "counts")
    whole = counts.groupBy("source", "metric").agg(F.sum("n").alias("whole_n"), F.min("min").alias("whole_min"), F.max("max").alias("whole_max"), *(F.sum(c).alias(f"whole_{c}") for c in counts.columns if c.endswith(tuple(f"all{p}" for p in PCTS))))
    joined = estimates.drop("n").join(counts, keys).join(whole, ["source", "metric"])

    def one(scope: str, p: int) -> dict[str, Column]:
        r, w = f"{scope}{p}", "whole_" if scope == "all" else ""
        c = lambda name: F.col(f"{w}{name}_{r}")
        n, at, lo, hi = F.col(f"{w}n"), F.col(f"at_{r}"), F.col(f"lo_{r}"), F.col(f"hi_{r}")
        position = (n - 1) * p
        first, rest = F.floor(position / 100), (position % 100) / 100
        second = first + (rest > 0).cast("int")
        exact = (c("lt_lo") <= first) & (first < c("le_lo")) & (c("lt_hi") <= second) & (second < c("le_hi"))
        inside = (c("lt_lo") <= first) & (second < c("le_hi"))
        value = lo + rest * (hi - lo)
        return {
            "value": F.when(exact, value).otherwise(at), "rank_error": F.when(exact, 0.0).otherwise(F.greatest(F.lit(0.0), c("lt_at") - first - 1, first + 1 - c("le_at")) / n),
            "below": F.when(inside, c("lt_lo")).otherwise(0), "least": F.when(exact, value).when(inside, lo).otherwise(F.col(f"{w}min")), "most": F.when(exact, value).when(inside, hi).otherwise(F.col(f"{w}max")),
        }

    each = F.explode(F.array(*(
        F.struct(F.lit(p).alias("pct"), *(c.alias(k) for k, c in one("day", p).items()), *(c.alias({"value": "whole"}.get(k, f"whole_{k}")) for k, c in one("all", p).items())) for p in PCTS
    )))
    return joined.select("source", "day", "metric", "n", "whole_n", each.alias("e")).select("source", "day", "metric", "n", "whole_n", "e.*")


#: Cells that a bracket is cut into in one round of exact search.
CELLS = 1024


def exact_ranks(values: DataFrame, wanted: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The exact interpolated percentiles of ``wanted(source, metric, day, pct, n, least, most, below)``; null day: all days.

    The percentiles lie within their certified bounds, ``below`` values are less than
    ``least``; bounds that are equal are the percentile. Each round counts the values inside
    each bracket by CELLS cells, in one aggregate that combines before the shuffle, and goes on
    with the cell that holds the wanted rank, until that has one value or the two ranks to
    interpolate fall into different cells.
    """
    key = ["source", "metric", "day", "pct"]
    position = (F.col("n") - 1) * F.col("pct")
    first = F.floor(position / 100).cast("long")
    done = wanted.where("least = most").select(*key, F.col("least").alias("value"))
    state = ["first", "second", "rest", "lo", "hi", "below"]
    open_ = wanted.where("least < most").select(*key, first.alias("first"), (first + (position % 100 > 0).cast("long")).alias("second"), ((position % 100) / 100).alias("rest"), F.col("least").alias("lo"), F.col("most").alias("hi"), "below")
    open_ = materialize(open_, "ranks")
    x = _long(values)
    for _ in range(max_rounds):
        if not open_.limit(1).count():
            return done
        days = x.join(open_.where("day is not null"), ["source", "metric", "day"]).where("x between lo and hi").select(*key, *state, "x")
        wholes = x.drop("day").join(open_.where("day is null"), ["source", "metric"]).where("x between lo and hi").select(*key, *state, "x")
        share = F.when(F.col("hi") > F.col("lo"), (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
        cell = F.least(F.floor(share * CELLS).cast("int"), F.lit(CELLS - 1)).alias("cell")
        cells = days.unionByName(wholes).groupBy(*key, *state, cell).agg(F.count("*").alias("c"), F.min("x").alias("min"), F.max("x").alias("max"))
        end = F.col("below") + F.sum("c").over(Window.partitionBy(*key).orderBy("cell"))
        cells = cells.withColumn("end", end).withColumn("start", F.col("end") - F.col("c"))
        holds = lambda rank: (F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("end"))
        pick = cells.groupBy(*key, "first", "second", "rest").agg(*(F.max(F.when(holds(rank), F.col(c))).alias(f"{rank}_{c}") for rank in ("first", "second") for c in ("cell", "min", "max", "start")))
        pick = materialize(pick, "ranks")
        split = F.col("first_cell") != F.col("second_cell")
        a, b = F.when(split, F.col("first_max")).otherwise(F.col("first_min")), F.when(split, F.col("second_min")).otherwise(F.col("second_max"))
        finished = split | (F.col("first_min") == F.col("first_max"))
        done = done.unionByName(pick.where(finished).select(*key, (a + F.col("rest") * (b - a)).alias("value")))
        open_ = pick.where(~finished).select(*key, "first", "second", "rest", F.col("first_min").alias("lo"), F.col("first_max").alias("hi"), F.col("first_start").alias("below"))
    raise RuntimeError(f"not found after {max_rounds} rounds")


def _far(value_least: Column, value_most: Column, whole_least: Column, whole_most: Column, factor: float) -> Column:
    """Whether a value is more than ``factor`` times or less than 1/factor of another; null where the bounds leave it open."""
    yes = (value_least > factor * whole_most) | (value_most < whole_least / factor)
    no = (value_most <= factor * whole_least) & (value_least >= whole_most / factor)
    return F.when(yes, True).when(no, False)


def far_percentiles(values: DataFrame, percentiles: DataFrame, least_n: int, factor: float) -> DataFrame:
    """Day percentiles (source, day, metric, pct) far from the same percentile of all days.

    Where the certified bounds decide, they do; the rest is searched exactly.
    """
    judged = percentiles.where(F.col("n") >= least_n).withColumn("far", _far(F.col("least"), F.col("most"), F.col("whole_least"), F.col("whole_most"), factor))
    judged = materialize(judged, "judged")
    unclear, cols = judged.where("far is null"), ["source", "day", "metric", "pct"]
    days = unclear.select("source", "metric", "day", "pct", "n", "least", "most", "below")
    wholes = unclear.select("source", "metric", F.lit(None).cast("string").alias("day"), "pct", F.col("whole_n").alias("n"), F.col("whole_least").alias("least"), F.col("whole_most").alias("most"), F.col("whole_below").alias("below")).distinct()
    exact = exact_ranks(values, days.unionByName(wholes))
    whole = exact.where("day is null").select("source", "metric", "pct", F.col("value").alias("whole"))
    value = F.col("value")
    found = exact.where("day is not null").join(whole, ["source", "metric", "pct"]).where(_far(value, value, F.col("whole"), F.col("whole"), factor))
    return judged.where("far").select(cols).unionByName(found.select(cols))


def frame_percentiles(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(values, certified percentiles) of the frames' clock deltas by sensor and UTC day.

    Frames equal in sensor, time and dedupe_key count once (a null key is never a repeat).
    Null sensors or times are left out. Empty input gives no rows.
    """
    values = clean_values(frames)
    return values, certified(values, materialize(day_percentiles(values), "percentiles"))
