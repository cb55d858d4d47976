"""Queries of the general data problems (1, 3, 4, 5) and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.mac import epoch_us
from skysift.operators.deliveries import mark_surplus
from skysift.operators.nested import nested_nodes, nested_values
from skysift.operators.sessions import frame_sessions
from skysift.operators.signal import signal_anomalies
from skysift.session import materialize
from skysift.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return signal_anomalies(table(spark, d, "projection_frames")).select("dedupe_key")


def p1_flags(spark: SparkSession, d: str) -> DataFrame:
    return signal_anomalies(table(spark, d, "projection_frames"))


def _deliveries(spark: SparkSession, d: str, *carried: str) -> DataFrame:
    rows = table(spark, d, "broker_records").select("stream_name", "dedupe_key", epoch_us(F.col("received_at")).alias("at_us"), F.col("delivery_id").alias("row_id"), *carried)
    return mark_surplus(rows, *carried)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _deliveries(spark, d).where("surplus").select(F.col("row_id").alias("delivery_id"))


def p3_kept(spark: SparkSession, d: str) -> DataFrame:
    kept = _deliveries(spark, d, "record_offset", "payload_sha256").where("not surplus")
    return kept.select("stream_name", "dedupe_key", F.col("row_id").alias("delivery_id"), "record_offset", "payload_sha256")


def p3_copies(spark: SparkSession, d: str) -> DataFrame:
    """Each surplus delivery with the one kept, and whether position and payload are the same."""
    marked = materialize(_deliveries(spark, d, "topic", "partition_id", "record_offset", "payload_sha256"), "marked")
    keys = ["stream_name", "dedupe_key"]
    first = marked.where("not surplus").select(*keys, F.col("row_id").alias("kept_id"), F.struct("topic", "partition_id", "record_offset").alias("at"), F.col("payload_sha256").alias("payload"))
    return marked.where("surplus").join(first, keys).select(
        F.col("row_id").alias("delivery_id"), "kept_id", (F.struct("topic", "partition_id", "record_offset") == F.col("at")).alias("same_position"), F.col("payload_sha256").eqNullSafe(F.col("payload")).alias("same_payload")
    )


def p3_ledger_kept(spark: SparkSession, d: str) -> DataFrame:
    """The ledger's messages, each kept in its earliest copy (by updated_at)."""
    rows = table(spark, d, "sync_events").select("stream_name", "dedupe_key", epoch_us(F.col("updated_at")).alias("at_us"), F.lit(0).cast("long").alias("row_id"))
    return mark_surplus(rows).where("not surplus").select("stream_name", "dedupe_key", F.col("at_us").alias("updated_us"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return nested_nodes(table(spark, d, "sync_events")).select("stream_name", "dedupe_key", "node_path", "parent_path")


def p4_nodes(spark: SparkSession, d: str) -> DataFrame:
    return nested_nodes(table(spark, d, "sync_events"))


def p4_values(spark: SparkSession, d: str) -> DataFrame:
    return nested_values(table(spark, d, "sync_events"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return frame_sessions(table(spark, d, "projection_frames")).select(F.col("source").alias("source_mac"), "start_us", "end_us")


def p5_sessions(spark: SparkSession, d: str) -> DataFrame:
    return frame_sessions(table(spark, d, "projection_frames")).select(F.col("source").alias("source_mac"), "start_us", "end_us", "duration_us", F.col("events").alias("frame_count"))


QUERIES = {
    "p1_found": p1_found,
    "p1_flags": p1_flags,
    "p3_found": p3_found,
    "p3_kept": p3_kept,
    "p3_copies": p3_copies,
    "p3_ledger_kept": p3_ledger_kept,
    "p4_found": p4_found,
    "p4_nodes": p4_nodes,
    "p4_values": p4_values,
    "p5_found": p5_found,
    "p5_sessions": p5_sessions,
}

_CANON = "CASE WHEN length(regexp_replace(lower({0}), '[^0-9a-f]', '', 'g')) = 12 THEN array_to_string(list_transform(range(6), lambda i: substr(regexp_replace(lower({0}), '[^0-9a-f]', '', 'g'), CAST(2*i+1 AS BIGINT), 2)), ':') ELSE lower(trim({0})) END"


def canon_sql(c: str) -> str:
    return _CANON.format(c)


_SESSIONS = f"""
WITH f AS (SELECT DISTINCT {canon_sql('source_mac')} AS m, epoch_us(observed_at) AS t, dedupe_key AS k FROM projection_frames WHERE source_mac IS NOT NULL),
g AS (SELECT m, t, CASE WHEN t - lag(t) OVER w > 1800000000 THEN 1 ELSE 0 END AS cut FROM f WINDOW w AS (PARTITION BY m ORDER BY t, k)),
s AS (SELECT m, t, sum(cut) OVER (PARTITION BY m ORDER BY t ROWS UNBOUNDED PRECEDING) AS part FROM g),
r AS (SELECT m AS source_mac, min(t) AS start_us, max(t) AS end_us, max(t) - min(t) AS duration_us, count(*) AS frame_count FROM s GROUP BY m, part)
SELECT {{}} FROM r"""

_FIRST = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY stream_name, dedupe_key ORDER BY received_at, delivery_id) AS k FROM broker_records)
SELECT {} FROM r WHERE k {} 1"""

_TREE = r"""
WITH c AS (SELECT stream_name, dedupe_key, updated_at, CASE WHEN ltrim(payload) LIKE '"%' THEN json_extract_string(payload, '$') ELSE payload END AS p FROM sync_events WHERE json_valid(payload)),
m AS (SELECT stream_name, dedupe_key, arg_max(p, (updated_at, p)) AS p FROM c WHERE json_valid(p) AND left(ltrim(p), 1) IN ('{', '[') GROUP BY 1, 2),
t AS (SELECT m.stream_name, m.dedupe_key, j.type, j.value, regexp_replace(substr(replace(j.fullkey, '"', ''), 2), '^\.', '') AS path FROM m, json_tree(m.p) AS j),
e AS (SELECT stream_name, dedupe_key, path AS node_path FROM t WHERE type = 'OBJECT' AND path LIKE '%]'),
n AS (SELECT a.stream_name, a.dedupe_key, a.node_path, coalesce(arg_max(b.node_path, length(b.node_path)), '$') AS parent_path
 FROM e AS a LEFT JOIN e AS b ON a.stream_name = b.stream_name AND a.dedupe_key = b.dedupe_key
  AND length(b.node_path) < length(a.node_path) AND starts_with(a.node_path, b.node_path) AND substr(a.node_path, length(b.node_path) + 1, 1) IN ('.', '[')
 GROUP BY ALL)"""

_NODES = _TREE + r"""
SELECT *, regexp_replace(node_path, '\[[0-9]+\]', '[]', 'g') AS table_path, CAST(regexp_extract(node_path, '([0-9]+)\]$', 1) AS BIGINT) AS ordinal FROM n"""

_LEAVES = _TREE + r""",
s AS (SELECT stream_name, dedupe_key, path, CAST(value AS VARCHAR) AS value FROM t WHERE type NOT IN ('OBJECT', 'ARRAY')),
h AS (SELECT s.stream_name, s.dedupe_key, s.path, any_value(s.value) AS value, coalesce(arg_max(b.node_path, length(b.node_path)), '$') AS node_path
 FROM s LEFT JOIN e AS b ON s.stream_name = b.stream_name AND s.dedupe_key = b.dedupe_key AND starts_with(s.path, b.node_path || '.') GROUP BY ALL)
SELECT stream_name, dedupe_key, node_path, CASE WHEN node_path = '$' THEN path ELSE substr(path, length(node_path) + 2) END AS member, value FROM h"""

ORACLES = {
    "p3_found": _FIRST.format("delivery_id", ">"),
    "p3_kept": _FIRST.format("stream_name, dedupe_key, delivery_id, record_offset, payload_sha256", "="),
    "p3_copies": """
SELECT r.delivery_id, f.delivery_id AS kept_id, r.topic = f.topic AND r.partition_id = f.partition_id AND r.record_offset = f.record_offset AS same_position, r.payload_sha256 IS NOT DISTINCT FROM f.payload_sha256 AS same_payload
FROM broker_records r JOIN (SELECT * FROM broker_records QUALIFY row_number() OVER (PARTITION BY stream_name, dedupe_key ORDER BY received_at, delivery_id) = 1) f ON f.stream_name = r.stream_name AND f.dedupe_key = r.dedupe_key WHERE r.delivery_id <> f.delivery_id""",
    "p3_ledger_kept": "SELECT stream_name, dedupe_key, min(epoch_us(updated_at)) AS updated_us FROM sync_events GROUP BY 1, 2",
    "p4_found": _TREE + " SELECT * FROM n",
    "p4_nodes": _NODES,
    "p4_values": _LEAVES,
    "p5_found": _SESSIONS.format("source_mac, start_us, end_us"),
    "p5_sessions": _SESSIONS.format("source_mac, start_us, end_us, duration_us, frame_count"),
}
