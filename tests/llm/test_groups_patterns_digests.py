"""Problems 2, 6 and 7 against brute force, and their edge cases."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import skysift.llm.groups as groups
import skysift.llm.patterns as patterns
from skysift.llm import digests
from skysift.llm.digests import exact_ranks, far_percentiles, frame_percentiles, merge, of_values, quantile
from skysift.llm.groups import connected_groups
from skysift.llm.patterns import frequent_patterns


def brute_groups(pairs):
    root = {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {v: find(v) for v in root}


@pytest.mark.parametrize("hot", [10_000, 5])
def test_groups(spark, monkeypatch, hot):
    monkeypatch.setattr(groups, "LEAST_HOT", hot)
    rng = random.Random(hot)
    pairs = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("hub", f"s{i}") for i in range(80)] + [(f"r{rng.randrange(90)}", f"r{rng.randrange(90)}") for _ in range(70)]
    pairs += [("x", None), (None, "y"), ("self", "self"), ("b", "a"), ("a", "b"), ("a", "b")]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("v", F.lit("clash"))
    got = {r.v: r.group for r in connected_groups(df).collect()}
    assert got == brute_groups(pairs)


def test_no_groups(spark):
    assert connected_groups(spark.createDataFrame([], "a string, b string")).count() == 0
    assert connected_groups(spark.createDataFrame([("a", "a"), (None, None)], "a string, b string")).count() == 0


def holds(pattern, seq):
    it = iter(seq)
    return all(x in it for x in pattern)


def brute_patterns(rows, share, lo, hi):
    by = {}
    for e, t in rows:
        t = [x for x in (t or []) if x]
        if e is not None and t:
            by.setdefault(e, []).append(t)
    letters = sorted({x for v in by.values() for t in v for x in t})
    level, out = [()], {}
    for k in range(1, hi + 1):
        nxt = []
        for p in level:
            for a in letters:
                q = (*p, a)
                n = sum(any(holds(q, t) for t in v) for v in by.values())
                if n >= share * len(by) - 1e-9:
                    nxt.append(q)
                    if k >= lo:
                        out[" ".join(q)] = n
        level = nxt
    return out, len(by)


@pytest.mark.parametrize(("tokens", "hot", "lo"), [(2_000_000, 10_000, 2), (300, 10_000, 1), (120, 2, 2)])
def test_patterns(spark, monkeypatch, tokens, hot, lo):
    monkeypatch.setattr(patterns, "BUCKET_TOKENS", tokens)
    monkeypatch.setattr(patterns, "HOT_SEQUENCES", hot)
    rng = random.Random(8)
    rows = [(f"e{i}", [rng.choice(["a", "b", "c", "dd", "", None]) for _ in range(rng.randrange(9))]) for i in range(200)]
    rows += [(f"e{i % 7}", [rng.choice("abcz") for _ in range(5)]) for i in range(60)]
    rows += rows[::5] + [("e1", ["c", "c", "a"]), ("e1", ["b", "dd"]), (None, ["a"]), ("null", None), ("empty", []), ("long", ["a", "b"] * 2000)]
    df = spark.createDataFrame(rows, "entity string, tokens array<string>").withColumn("pattern", F.lit("clash"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    got = {r.pattern: r.support for r in frequent_patterns(df, 0.06, lo, 4).collect()}
    want, n = brute_patterns([r if r[0] != "long" else ("long", ["a", "b"] * 5) for r in rows], 0.06, lo, 4)
    assert got == want and frequent_patterns(df, 0.06, lo, 4).first().entities == n


def test_no_patterns(spark):
    assert frequent_patterns(spark.createDataFrame([], "entity string, tokens array<string>"), 0.06, 3, 5).count() == 0
    assert frequent_patterns(spark.createDataFrame([("a", [])], "entity string, tokens array<string>"), 0.06, 3, 5).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=80), st.floats(0, 1))
def test_small_digest_is_exact(values, p):
    parts = [of_values(np.array(values[i::3], float)) for i in range(3) if values[i::3]]
    assert quantile(*merge(parts), p) == pytest.approx(float(np.quantile(values, p)))


def test_large_digest_has_small_rank_error():
    rng = np.random.default_rng(3)
    for x in (rng.lognormal(0, 3, 200_000), np.repeat(np.arange(50.0), 3000), rng.normal(size=100_000)):
        mean, weight, pure = merge([of_values(c) for c in np.array_split(rng.permutation(x), 37)])
        assert len(mean) <= 500 and weight.sum() == len(x)
        s = np.sort(x)
        for p in (0.01, 0.5, 0.95, 0.999):
            q = quantile(mean, weight, pure, p)
            lo, hi = np.searchsorted(s, q) / len(x), np.searchsorted(s, q, side="right") / len(x)
            assert max(lo - p, p - hi, 0) < 0.004


@pytest.mark.parametrize(("delta", "cells"), [(1000, 1024), (24, 4)])
def test_frame_percentiles(spark, monkeypatch, delta, cells):
    """With few centroids brackets are wide, and what they leave open is searched exactly."""
    monkeypatch.setattr(digests.cluster, "__defaults__", (delta,))
    monkeypatch.setattr(digests, "CELLS", cells)
    rng = np.random.default_rng(4)
    t0 = datetime(2021, 1, 4, 20)
    rows = [(f"k{i}", "hot" if i % 3 else "cold", t0 + timedelta(seconds=40 * i), int(v) * (1 + i // 1500), int(v) % 7 if i % 5 else None, "clash") for i, v in enumerate(rng.lognormal(5, 1, 4000))]
    df = spark.createDataFrame(rows + rows[::11] + [("x", None, t0, 1, 1, ""), ("y", "hot", None, 1, 1, "")], "dedupe_key string, sensor_id string, observed_at timestamp_ntz, tsft_delta_us long, wall_clock_delta_ms long, day string")
    values, percentiles = frame_percentiles(df)
    got = percentiles.collect()
    by, whole = {}, {}
    for _, s, t, a, b, _ in rows:
        for m, v in (("tsft_delta_us", a), ("wall_clock_delta_ms", b)):
            if v is not None:
                by.setdefault((s, f"{t:%Y-%m-%d}", m), []).append(v)
                whole.setdefault((s, m), []).append(v)
    assert len(got) == 2 * len(by)
    far, unclear = set(), 0
    for r in got:
        v, w = by[r.source, r.day, r.metric], whole[r.source, r.metric]
        exact, exact_whole = np.quantile(v, r.pct / 100), np.quantile(w, r.pct / 100)
        assert r.n == len(v) and r.whole_n == len(w) and r.rank_error <= 4 / delta and r.whole_rank_error <= 4 / delta
        assert r.least - 1e-9 <= exact <= r.most + 1e-9 and r.whole_least - 1e-9 <= exact_whole <= r.whole_most + 1e-9
        if len(v) <= delta / 2:
            assert r.value == pytest.approx(exact) and r.rank_error == 0
        if len(v) >= 60 and (exact > 1.5 * exact_whole or exact < exact_whole / 1.5):
            far.add((r.source, r.day, r.metric, r.pct))
        unclear += (r.least <= 1.5 * r.whole_most and r.most > 1.5 * r.whole_least) or (r.most >= r.whole_least / 1.5 and r.least < r.whole_most / 1.5)
    assert {tuple(r) for r in far_percentiles(values, percentiles, 60, 1.5).collect()} == far and far
    assert (unclear > 0) == (delta == 24)
    wanted = [(s, m, d, p, len(x), float(min(x)), float(max(x)), 0) for (s, d, m), x in [*by.items(), *(((s, None, m), x) for (s, m), x in whole.items())] for p in (50, 95)]
    exact = exact_ranks(values, spark.createDataFrame(wanted, "source string, metric string, day string, pct int, n long, least double, most double, below long")).collect()
    assert len(exact) == len(wanted)
    for r in exact:
        assert r.value == pytest.approx(np.quantile(by[r.source, r.day, r.metric] if r.day else whole[r.source, r.metric], r.pct / 100))
    certain = percentiles.select("source", "metric", "day", "pct", "n", "least", "most", "below")
    for r in exact_ranks(values, certain).collect():
        assert r.value == pytest.approx(np.quantile(by[r.source, r.day, r.metric], r.pct / 100))
    values, percentiles = frame_percentiles(df.where("false"))
    assert percentiles.count() == 0 and far_percentiles(values, percentiles, 60, 2.0).count() == 0
