"""Operators of problems 1, 3, 4 and 5 against brute force, and their edge cases."""

import json
import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skysift.operators import nested
from skysift.operators import deliveries
from skysift.operators.deliveries import PIECE, Identifiers, QuotientTable, mark_surplus, permute
from skysift.operators.nested import Shredded, nested_nodes, nested_values, readable
from skysift.operators.sessions import sessionize
from skysift.operators.signal import esd_outliers, resolution, run_limit, signal_anomalies

T0 = datetime(2021, 1, 4)
FRAMES = "dedupe_key string, sensor_id string, observed_at timestamp_ntz, signal_dbm int, source_mac string, source string"


def frame(i, sensor, minutes, signal):
    return (f"k{i:06d}", sensor, T0 + timedelta(minutes=minutes), signal, "02:00:00:00:00:01", "clash")


def flags(spark, rows):
    out = signal_anomalies(spark.createDataFrame(rows, FRAMES)).collect()
    return {r.dedupe_key: (r.impossible, r.stuck, r.spike) for r in out}


def test_signal_anomalies_find_what_was_planted(spark):
    rng = random.Random(5)
    rows = [frame(i, "a" if i % 3 else "b", i * 2, round(rng.gauss(-60 + 4 * np.sin(i / 115), 2.5)) + (8 if i > 6000 else 0)) for i in range(9000)]
    want = {}
    for i, v in ((100, -110), (2000, -20), (7001, -95)):
        rows[i] = rows[i][:3] + (v,) + rows[i][4:]
        want[rows[i][0]] = (0, 0, 1)
    for i, v in ((50, 127), (51, -9999), (60, 0), (70, -128)):
        rows[i] = rows[i][:3] + (v,) + rows[i][4:]
        want[rows[i][0]] = (1, 0, 0)
    run = [i for i in range(3000, 3120) if i % 3][:40]
    for i in run:
        rows[i] = rows[i][:3] + (-61,) + rows[i][4:]
    got = flags(spark, rows + rows[::400])
    stuck = {k for k, v in got.items() if v[1]}
    assert {rows[i][0] for i in run} <= stuck and len(stuck) <= len(run) + 2
    assert {k: v for k, v in got.items() if not v[1]} == want


def test_signal_anomalies_edge_cases(spark):
    assert flags(spark, []) == {}
    rows = [frame(0, None, 1, -500), (None, "a", T0, -500, "", ""), frame(2, "a", 1, None), ("k3", "a", None, 99, None, None), frame(4, "a", 2, 99), frame(4, "a", 2, 99)]
    assert flags(spark, rows) == {"k000004": (1, 0, 0)}
    same = [frame(i, "only", i, -70) for i in range(300)]
    assert len(flags(spark, same)) == 300  # one value throughout is stuck


def test_a_block_of_one_reading_does_not_set_the_run_limit(spark):
    rng = random.Random(7)
    rows = [frame(i, "a", i * 3, round(rng.gauss(-60, 2.5))) for i in range(6000)]
    run = range(2000, 2024)
    for i in run:
        rows[i] = rows[i][:3] + (-61,) + rows[i][4:]
    for day in (26, 60):  # alone in its block: in the overlap of the others, and beyond it
        got = flags(spark, rows + [frame(9000, "a", day * 1440, -60)])
        stuck = {k for k, v in got.items() if v[1]}
        assert {rows[i][0] for i in run} <= stuck and len(stuck) <= len(run) + 2


def test_esd_and_run_limit():
    r = np.concatenate([np.random.default_rng(1).normal(0, 2, 5000), [30.0, -41.0]])
    assert set(np.flatnonzero(esd_outliers(r, np.ones(len(r), int)))) == {5000, 5001}
    assert not esd_outliers(np.zeros(5), np.ones(5, int)).any()
    assert 6 <= run_limit(r, np.ones(len(r), int)) <= 14


@pytest.mark.parametrize("share", [0.05, 0.15, 0.45])
def test_esd_finds_spikes_that_hide_each_other(share):
    rng = np.random.default_rng(3)
    n = round(5000 * share)
    r = np.concatenate([rng.normal(0, 2.5, 5000 - n), np.full(n, 30.0)])
    assert set(np.flatnonzero(esd_outliers(r, np.ones(5000, int)))) == set(range(5000 - n, 5000))
    value, count = np.unique(np.rint(r), return_counts=True)
    assert value[esd_outliers(value, count)].tolist() == [30.0]


def test_esd_takes_no_tails_for_spikes():
    rng = np.random.default_rng(4)
    for r in (rng.normal(0, 2.5, 9000), rng.uniform(-8, 8, 9000), rng.normal(0, 0.6, 9000)):
        assert not esd_outliers(np.rint(r), np.ones(9000, int)).any()
    assert esd_outliers(rng.laplace(0, 2, 9000), np.ones(9000, int)).sum() < 45
    coarse = 2 * np.rint(rng.normal(0, 0.6, 9000))  # a receiver that reports every second value
    assert resolution(coarse, np.ones(9000, int)) == 2 and not esd_outliers(coarse, np.ones(9000, int), step=2).any()


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_sessions_equal_brute_force(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.4 else f"m{rng.randrange(30)}", rng.randrange(200_000), f"k{i}") for i in range(3000)]
    rows += rows[::17] + [(None, 5, "x"), ("m1", None, "y"), ("m2", 77, None), ("m2", 77, None)]
    got = sorted(tuple(r) for r in sessionize(spark.createDataFrame(rows, "source string, ts_us long, event_key string"), 500).collect())
    want, by = [], {}
    for s, t, k in rows:
        if s is not None and t is not None:
            by.setdefault(s, []).append((t, k))
    for s, x in by.items():
        seen = sorted({e for e in x if e[1] is not None}) + [e for e in x if e[1] is None]
        seen.sort(key=lambda e: e[0])
        start = prev = seen[0][0]
        n = 0
        for t, _ in seen:
            if t - prev > 500:
                want.append((s, start, prev, prev - start, n))
                start, n = t, 0
            prev, n = t, n + 1
        want.append((s, start, prev, prev - start, n))
    assert got == sorted(want)
    for c in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled"):
        spark.conf.unset(c)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_sessions_of_nothing(spark):
    assert sessionize(spark.createDataFrame([], "source string, ts_us long, event_key string, start_us long"), 5).count() == 0


def test_quotient_table_is_exact():
    rng = random.Random(3)
    tail = "t" * 900
    keys = [f"k{rng.randrange(4000)}" for _ in range(9000)] + [f"{rng.randrange(300)}{tail}{rng.randrange(3)}" for _ in range(2000)] + ["y" * n for n in range(3 * PIECE)] * 2
    rng.shuffle(keys)
    table, first = QuotientTable(bits=4), {}
    ids = [Identifiers(pa.array(["s"] * len(keys[i : i + 500])), pa.array(keys[i : i + 500])) for i in range(0, len(keys), 500)]
    new = np.concatenate([table.first_seen(x) for x in ids])
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    assert set(np.flatnonzero(new)) == set(first.values())
    homes = np.concatenate([x.homes() for x in ids])
    by = {}
    for k, h in zip(keys, homes.tolist()):
        assert by.setdefault(k, h) == h
    long = {h % 16 for k, h in by.items() if k.endswith((tail + "0", tail + "1"))}
    assert len(long) == 16 and len(set(by.values())) > 0.999 * len(by)
    entries = Identifiers(pa.array(["s"] * len(keys)), pa.array(keys)).entries(0, np.arange(len(keys)), np.zeros(len(keys), np.uint64))
    assert len(np.unique(permute(entries), axis=0)) == len(np.unique(entries, axis=0))
    # the same bytes split differently are different identifiers
    assert QuotientTable().first_seen(Identifiers(pa.array(["ab", "a", "ab"]), pa.array(["c", "bc", "c"]))).tolist() == [True, True, False]


def test_surplus_rows(spark, monkeypatch):
    monkeypatch.setattr(deliveries, "PER_TASK", 100)
    rng = random.Random(4)
    long = "x" * 70
    keys = [("s1", "hot")] * 300 + [(f"s{rng.randrange(3)}", f"k{rng.randrange(200)}") for _ in range(900)] + [("s", long), ("s", long), ("s", long + "y"), *[("s", long * 40)] * 90, (None, None), ("", ""), ("s", None)]
    rows = [(s, k, rng.randrange(50), i, "clash") for i, (s, k) in enumerate(keys)]
    df = spark.createDataFrame(rows, "stream_name string, dedupe_key string, at_us long, row_id long, shard string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    got = {r.row_id for r in mark_surplus(df).where("surplus").collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    best = {}
    for s, k, t, i, _ in rows:
        key = (s or "", k or "")
        best[key] = min(best.get(key, (t, i)), (t, i))
    assert got == {i for _, _, _, i, _ in rows} - {i for _, i in best.values()}
    assert mark_surplus(df.where("false")).count() == 0


def walk(v, path, parent, nodes, values, node):
    """Nodes and values of parsed JSON, by plain recursion."""
    items = v.items() if isinstance(v, dict) else enumerate(v)
    for k, x in items:
        p = (f"{path}.{k}" if path else k) if isinstance(v, dict) else f"{path}[{k}]"
        if isinstance(x, dict) and isinstance(v, list):
            nodes.append((p, parent))
            walk(x, p, p, nodes, values, p)
        elif isinstance(x, dict | list):
            walk(x, p, parent, nodes, values, node)
        else:
            base = "" if node == "$" else node
            values.append((node, p[len(base) :].lstrip("."), x))


def random_json(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    if kind == 0:
        return rng.choice([None, True, False])
    if kind == 1:
        return rng.randrange(-99, 99)
    if kind in (2, 3):
        return rng.choice(["", "plain", 'quo"te', "back\\slash", "{[,:]}", "ünï", "\\", '\\"', "new\nline"])
    if kind in (4, 5):
        return [random_json(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "b", 'k"q', "d\\", "e.f", "é", "z"]): random_json(rng, depth + 1) for _ in range(rng.randrange(4))}


def test_nested_equals_recursion(spark, monkeypatch):
    rng = random.Random(6)
    docs = [random_json(rng) for _ in range(600)]
    docs = [x if isinstance(x, dict | list) else [x, {"a": [x, {"b": [[{"c": x}]]}]}] for x in docs]
    texts = [json.dumps(x, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2])) for x in docs]
    texts[7] = json.dumps(texts[7])
    rows = [("s", f"k{i}", t, T0) for i, t in enumerate(texts)] + [("s", f"k{i}", texts[i], T0) for i in range(0, 600, 9)]
    rows += [("s", "bad", '{"a": [{"b": 1}', T0), ("s", "null", None, T0), ("s", "empty", "", T0), ("s", "scalar", "3", T0), (None, None, '[{"a":1}]', None), ("s", "deep", "[" * 40 + "{}" + "]" * 40, T0), ("s", "long", json.dumps({"a": ["x" * 300_000, {"b": 1}]}), T0)]
    df = spark.createDataFrame(rows, "stream_name string, dedupe_key string, payload string, updated_at timestamp_ntz").withColumn("node_path", F.lit("clash"))
    got = {(r.dedupe_key, r.node_path, r.parent_path) for r in nested_nodes(df).collect()}
    nodes, values = set(), []
    for key, x in [(f"k{i}", x) for i, x in enumerate(docs)] + [(None, [{"a": 1}]), ("deep", json.loads("[" * 40 + "{}" + "]" * 40)), ("long", {"a": ["", {"b": 1}]})]:
        n, v = [], []
        walk(x, "", "$", n, v, "$")
        nodes |= {(key, *y) for y in n}
        if key and key.startswith("k"):
            values += [(key, a, b, json.dumps(c, sort_keys=True)) for a, b, c in v]
    assert got == nodes
    monkeypatch.setattr(nested, "CHUNK_BYTES", 700)
    assert {(r.dedupe_key, r.node_path, r.parent_path) for r in nested_nodes(df).collect()} == nodes
    flat = [(r.dedupe_key, r.node_path, r.member, json.dumps(json.loads(r.value), sort_keys=True)) for r in nested_values(df).collect() if r.dedupe_key and r.dedupe_key.startswith("k")]
    assert sorted(flat) == sorted(values)
    assert nested_nodes(df.where("false")).count() == 0


def test_nested_reads_what_variant_rejects(spark):
    deep = '{"a":' * 1500 + '[{"b": 1}, {"c": [{}]}]' + "}" * 1500
    twice = '{"a": [{"b": 1}, {"b": 2}], "x": "]{", "a" : [ {"c": [{"d": "\\u00e9"}]} ]}'
    rows = [("s", k, t, T0) for k, t in (("twice", twice), ("wrapped", json.dumps(twice)), ("deep", deep), ("cut", twice[:-1]), ("comma", '{"a":1,"a":[{},]}'), ("more", '{"a":1,"a":[{}]}]'), ("number", '{"a":01,"a":[{}]}'))]
    df = spark.createDataFrame(rows, "stream_name string, dedupe_key string, payload string, updated_at timestamp_ntz")
    got = sorted((r.dedupe_key, r.node_path, r.parent_path) for r in nested_nodes(df).collect())
    top = ".".join("a" * 1500)
    nodes = [("a[0]", "$"), ("a[0].c[0]", "a[0]"), ("a[1]", "$")]
    assert got == sorted([("deep", f"{top}[0]", "$"), ("deep", f"{top}[1]", "$"), ("deep", f"{top}[1].c[0]", f"{top}[1]")] + [(k, *n) for k in ("twice", "wrapped") for n in nodes])
    values = {(r.node_path, r.member, r.value) for r in nested_values(df.where("dedupe_key = 'twice'")).collect()}
    assert values == {("a[0]", "b", "1"), ("a[1]", "b", "2"), ("$", "x", '"]{"'), ("a[0].c[0]", "d", '"\\u00e9"')}


def test_readable_equals_parser():
    """Broken texts stand between good ones, so that none may disturb its neighbours."""
    rng = random.Random(12)
    texts, want = [], []
    for k in range(4000):
        x = random_json(rng)
        text = json.dumps(x, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(['"', "]", "}", "[", "{", ",", ":", "\\", "\\u12", "x", "\t", "\x02", "", "0", "-", ".5", "e", " "]) + text[at + rng.randrange(2) :]
        if rng.random() < 0.2:
            text = json.dumps(text)
        texts.append(None if k % 97 == 0 else text)
        y = None
        try:
            y = json.loads(texts[-1] or "", parse_constant=int)
            for _ in range(2):
                y = json.loads(y, parse_constant=int) if isinstance(y, str) else y
        except ValueError:
            y = None
        want.append(y if isinstance(y, dict | list) else None)
    for size in (1, 7, 4000):
        got = [t for a in range(0, 4000, size) for t in readable(pa.array(texts[a : a + size], pa.string())).to_pylist()] if size > 1 else [readable(pa.array([t], pa.string()))[0].as_py() for t in texts[:300]]
        assert [t is None for t in got] == [y is None for y in want[: len(got)]]
        assert all(t is None or json.loads(t) == y for t, y in zip(got, want))


def test_shredding_nothing():
    assert len(Shredded(pa.array([], pa.string())).pos) == 0


def test_neighbour_counts(spark):
    from collections import Counter

    from skysift.operators.pairs import neighbour_counts

    rng = random.Random(9)
    rows = [("hot" if rng.random() < 0.5 else f"s{rng.randrange(20)}", i, f"k{i}", rng.choice("abc")) for i in range(2000)] + [(None, 1, "x", "a"), ("s1", 5, "y", None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "31")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {(r.previous, r.next): r.n for r in neighbour_counts(spark.createDataFrame(rows, "key string, ts_us long, tie string, value string")).collect()}
    for c in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled"):
        spark.conf.unset(c)
    by, want = {}, Counter()
    for k, _, _, v in rows:
        if k and v:
            by.setdefault(k, []).append(v)
    for v in by.values():
        want.update(zip(v, v[1:]))
    assert got == dict(want)
