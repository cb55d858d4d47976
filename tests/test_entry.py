"""The driver contract: names, SQL checks, and a few queries against their SQL."""

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as entry
from verify import duck, normal

DATA = "/root/testdata/sf0.001"
HAS_LLM = importlib.util.find_spec("skysift.llm") is not None


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 80
    assert HAS_LLM == any(k.startswith("p2_") for k in queries)


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
@pytest.mark.parametrize("name", ["p3_found", "p4_found", "p5_sessions", "q02_behavior_snapshot", "q03_timing_profile", "q05_transition_probabilities", "q18_identity_clusters", "q23_rollup_fold", "q29_json_projection", "q39_dedupe_first", "st03_dlq_split"])
def test_query_equals_sql(spark, name):
    con: duckdb.DuckDBPyConnection = duck(DATA)
    got = normal(entry.queries()[name](spark, DATA).toPandas())
    assert got.equals(normal(con.execute(entry.oracle_sql()[name]).df()))


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).columns == ["source_mac", "start_us", "end_us", "duration_us", "frame_count"]
