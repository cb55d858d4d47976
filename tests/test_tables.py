"""Declared schemas, processors, backlog."""

import os

import pytest

import __spark_entry__ as entry
from skysift.plans.processors import PROCESSORS, in_order
from skysift.plans.sinks import backlog_failed, backlog_prune, backlog_save, backlog_synced
from skysift.schemas import preflight, problems


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no test tables")
def test_preflight(spark):
    assert preflight(spark, "/root/testdata/sf0.001") == {}


def test_schema_problems(spark):
    df = spark.createDataFrame([(1, 2)], "item_id int, extra int")
    assert problems(df, "eval_items") == ["item_id: int, not bigint", "text: missing, not string"]


def test_processors():
    assert in_order(set(PROCESSORS)) == list(PROCESSORS)
    assert all(n in entry.queries() for _, queries in PROCESSORS.values() for n in queries)
    with pytest.raises(ValueError, match="needs"):
        in_order({"graph-projector"})


def test_backlog(spark):
    schema = "dedupe_key string, stream_name string, payload string, status string, attempts int, last_error string, next_attempt_us long, saved_us long"
    old = spark.createDataFrame([("a", "s", "1", "synced", 1, None, 0, 5), ("b", "s", "1", "pending", 0, None, 0, 5)], schema)
    new = spark.createDataFrame([("a", "s", "2", "pending", 0, None, 0, 9), ("c", "s", "2", "pending", 0, None, 0, 9)], schema)
    saved = backlog_save(old, new)
    assert {r.dedupe_key: (r.payload, r.status) for r in saved.collect()} == {"a": ("2", "synced"), "b": ("1", "pending"), "c": ("2", "pending")}
    failed = backlog_failed(saved, spark.createDataFrame([("b", "s", "e"), ("a", "s", "e")], "dedupe_key string, stream_name string, error string"), 100, 10)
    assert {r.dedupe_key: (r.status, r.attempts, r.next_attempt_us) for r in failed.collect()} == {"a": ("synced", 1, 0), "b": ("sync_failed", 1, 110), "c": ("pending", 0, 0)}
    synced = backlog_synced(failed, new.limit(2))
    assert {r.dedupe_key for r in backlog_prune(synced, 10).collect()} == {"b"}
