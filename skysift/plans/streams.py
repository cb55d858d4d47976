"""Streaming queries: each drains a file stream and returns the table it leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.mac import epoch_us
from skysift.plans.frames import FRAMES_SQL, HOUR, frames
from skysift.plans.ledger import made_results, moved
from skysift.plans.ledger import query as ledger
from skysift.plans.payloads import latest_payload, records_sql, sink_sql, transform
from skysift.plans.registry import Registry
from skysift.session import room
from skysift.sources.tables import table
from skysift.streaming.consumers import apply_backlog, device_replies, drain, evidence, fan_in, load, network_replies, probe_merge, resolved
from skysift.streaming.ingest import dead_letters, decode_requests, latest_windows, run_ledger, run_windows

query = Registry()


def stream_of(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A stored table (file or folder) as a file stream."""
    schema = table(spark, d, name).schema
    return spark.readStream.schema(schema).parquet(f"{d}/{name}.parque[t]")


@query("st01_dedupe_stream", """
SELECT stream_name, dedupe_key, min(delivery_id) AS delivery_id FROM (SELECT *, row_number() OVER (PARTITION BY stream_name, dedupe_key ORDER BY received_at, delivery_id) AS k FROM broker_records) WHERE k = 1 GROUP BY 1, 2""")
def dedupe_stream(spark: SparkSession, d: str) -> DataFrame:
    place = room(spark, "st01")
    run_ledger(stream_of(spark, d, "broker_records"), f"{place}/ledger", f"{place}/checkpoint", ["stream_name", "dedupe_key"], ["received_at", "delivery_id"])
    return spark.read.parquet(f"{place}/ledger").select("stream_name", "dedupe_key", "delivery_id")


@query("st02_tumbling_upsert", f"SELECT epoch_us({HOUR}) AS window_us, sensor_id, count(*) AS n FROM projection_frames WHERE sensor_id IS NOT NULL GROUP BY 1, 2")
def tumbling_upsert(spark: SparkSession, d: str) -> DataFrame:
    place = room(spark, "st02")
    source = stream_of(spark, d, "projection_frames").where("sensor_id is not null").select(F.col("observed_at").cast("timestamp").alias("at"), "sensor_id")
    run_windows(source, "at", "sensor_id", f"{place}/windows", f"{place}/checkpoint")
    return latest_windows(spark, f"{place}/windows", "sensor_id").select(F.unix_micros("window_start").alias("window_us"), "sensor_id", "n")


_STREAMS = ("wireless.audit", "proxy.events", "wireless.probe.flush")


@query("st03_dlq_split", f"""
SELECT coalesce(message_key, partition_id || ':' || record_offset) AS key, CASE WHEN message_key IS NULL THEN 'dedupe_key is missing' ELSE 'stream is not configured' END AS error, topic, CAST(partition_id AS BIGINT) AS partition, record_offset AS position
FROM broker_records WHERE stream_name NOT IN {_STREAMS} OR message_key IS NULL""")
def dlq_split(spark: SparkSession, d: str) -> DataFrame:
    """Requests built from deliveries (a missing message key gives a bad one); returns the dead letters."""
    place = room(spark, "st03")
    request = F.to_json(F.struct("stream_name", F.col("message_key").alias("dedupe_key"), F.concat(F.lit("inline://"), "stream_name").alias("payload_ref"), F.date_format(F.col("received_at").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("observed_at")))
    records = stream_of(spark, d, "broker_records").select("topic", F.col("partition_id").alias("partition"), F.col("record_offset").alias("offset"), F.col("message_key").alias("key"), request.alias("value"))
    bad = dead_letters(decode_requests(records, _STREAMS), "ingest-v1")
    bad.writeStream.format("parquet").option("path", f"{place}/dlq").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    member = lambda c: F.get_json_object("value", f"$.{c}")
    return spark.read.schema(bad.schema).parquet(f"{place}/dlq").select("key", member("error").alias("error"), member("topic").alias("topic"), member("partition").cast("long").alias("partition"), member("offset").cast("long").alias("position"))


_ALL = ("wireless.audit", "proxy.events", "wireless.probe.flush", "wireless.client.inventory", "audit.wireless.bandwidth", "wireless.alert.sequence", "wireless.alert.attack_sequence")


@query("st04_scan_requests", """
WITH k AS (SELECT payload_sha256, min(payload) AS payload FROM sync_events WHERE payload IS NOT NULL GROUP BY 1),
r AS (SELECT e.stream_name, e.dedupe_key, epoch_us(e.created_at) AS position, CASE WHEN json_valid(e.payload) THEN e.payload WHEN e.stream_name <> 'wireless.audit' AND json_valid(k.payload) THEN k.payload END AS text FROM sync_events e LEFT JOIN k ON k.payload_sha256 = e.payload_sha256),
f AS (SELECT stream_name, dedupe_key, min(position) AS first FROM r WHERE text IS NOT NULL GROUP BY 1, 2)
SELECT r.stream_name, r.dedupe_key, r.position, sha256(text) AS payload_sha256, CASE WHEN text IS NULL THEN 'dead_lettered' WHEN r.position = f.first THEN 'processed' ELSE 'duplicate' END AS disposition FROM r LEFT JOIN f ON f.stream_name = r.stream_name AND f.dedupe_key = r.dedupe_key""")
def scan_requests(spark: SparkSession, d: str) -> DataFrame:
    """Scan requests with inline payloads, or digests of stored ones, resolved in the stream; returns the evidence of every position."""
    place = room(spark, "st04")
    inline = F.concat(F.lit("inline://json/"), F.rtrim(F.translate(F.base64(F.encode("payload", "UTF-8")), "+/\r\n", "-_"), F.lit("=")))
    ref = F.when(F.try_parse_json("payload").isNotNull(), inline).otherwise(F.concat(F.lit("sha256://"), "payload_sha256"))
    request = F.to_json(F.struct("stream_name", "dedupe_key", ref.alias("payload_ref"), F.date_format(F.col("observed_at").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("observed_at")))
    records = stream_of(spark, d, "sync_events").select(F.col("stream_name").alias("topic"), F.lit(0).alias("partition"), epoch_us(F.col("created_at")).alias("offset"), F.lit(None).cast("string").alias("key"), request.alias("value"))
    known = table(spark, d, "sync_events").where("payload is not null").groupBy("payload_sha256").agg(F.min("payload").alias("payload"))

    def handle(batch: DataFrame) -> dict[str, DataFrame]:
        requests = resolved(decode_requests(batch, _ALL), known)
        return {"evidence": evidence(requests, known.sparkSession.createDataFrame([], "stream_name string, dedupe_key string"), "ingest-v1"), "dlq": dead_letters(requests, "ingest-v1")}

    drain(records, handle, place, f"{place}/checkpoint")
    return spark.read.parquet(f"{place}/evidence").select("stream_name", "dedupe_key", F.col("offset").alias("position"), "payload_sha256", "disposition")


_LOADED = ("proxy.events", "wireless.alert.sequence")


def _loaded_sql(kind: str, stream: str) -> str:
    return f"SELECT '{stream}' AS job_id, dedupe_key AS batch_id, count(*) AS n, min(error) AS error FROM ({sink_sql(kind, records_sql(stream))}) GROUP BY 1, 2"


@query("st05_load_stream", f"""
WITH l AS ({_loaded_sql('proxy_events', 'proxy.events')} UNION ALL {_loaded_sql('sequence_alert', 'wireless.alert.sequence')}), a AS (SELECT DISTINCT stream_name, dedupe_key FROM sync_events WHERE stream_name IN {_LOADED} AND payload IS NOT NULL)
SELECT a.stream_name AS job_id, a.dedupe_key AS batch_id, CASE WHEN n > 0 AND error IS NULL THEN 'success' ELSE 'failed' END AS status, CASE WHEN n > 0 AND error IS NULL THEN n ELSE 0 END AS row_count, CASE WHEN n > 0 AND error IS NULL THEN '' ELSE 'permanent' END AS error_class,
 CASE WHEN n > 0 AND error IS NULL THEN '' ELSE coalesce('missing ' || error, 'no readable record') END AS error_text FROM a LEFT JOIN l ON l.job_id = a.stream_name AND l.batch_id = a.dedupe_key""")
def load_stream(spark: SparkSession, d: str) -> DataFrame:
    """Load messages through the transforms of their sinks; returns the results that go on to the result stream."""
    place = room(spark, "st05")
    source = stream_of(spark, d, "sync_events").where(F.col("stream_name").isin(*_LOADED) & F.col("payload").isNotNull()).select("stream_name", "dedupe_key", "payload", "updated_at")

    def handle(batch: DataFrame) -> dict[str, DataFrame]:
        latest = batch.groupBy("stream_name", "dedupe_key").agg(latest_payload().alias("payload"))
        return load(latest, {kind: (stream, lambda rows, kind=kind: transform(rows, kind)) for kind, stream in zip(("proxy_events", "sequence_alert"), _LOADED)})

    drain(source, handle, place, f"{place}/checkpoint")
    return spark.read.parquet(f"{place}/results").drop("epoch")


@query("st06_result_stream", ledger.oracles["q48b_result_transition"])
def result_stream(spark: SparkSession, d: str) -> DataFrame:
    """Results decoded in the stream and applied to their batches; refused ones are kept with their error."""
    place = room(spark, "st06")
    drain(stream_of(spark, d, "sync_events"), lambda batch: {"states": moved(made_results(batch))}, place, f"{place}/checkpoint")
    return spark.read.parquet(f"{place}/states").drop("epoch")


NOW_US = 1_611_532_800_000_000
BACKLOG = "stream_name string, dedupe_key string, status string, stage string, payload string, attempts long, saved_us long, next_us long"


def service_requests(events: DataFrame) -> DataFrame:
    """Backlog requests made of ledger rows, some of them bad, and one request each for the list and for pruning."""
    topic = lambda name, cond, body: F.when(cond, F.struct(F.lit(name).alias("topic"), F.col("dedupe_key").alias("key"), F.to_json(body).alias("value")))
    key = F.when(F.col("payload").isNull() & (F.col("status") == "batched"), "").otherwise(F.col("dedupe_key"))
    stage = F.when(F.col("status") == "failed", "post_publish").when(F.col("status") == "done", "pre_publish")
    saved = topic("backlog.save", F.col("status").isin("pending", "failed", "done") | F.col("payload").isNull(), F.struct(key.alias("dedupe_key"), "stream_name", stage.alias("failure_stage")))
    synced = topic("backlog.synced", F.col("status") == "done", F.struct("dedupe_key", "stream_name"))
    return events.select(F.explode(F.filter(F.array(saved, synced), lambda x: x.isNotNull())).alias("r")).select("r.*")


def _consume(spark: SparkSession, d: str, name: str) -> DataFrame:
    place = room(spark, "st07")
    devices = frames(spark, d).select(F.col("source_mac").alias("mac_id")).distinct().select("mac_id", F.lit(None).cast("string").alias("username"), F.concat(F.lit("device "), F.right("mac_id", F.lit(5))).alias("display_name"), F.lit(None).cast("string").alias("hostname"))
    networks = table(spark, d, "wireless_authorized_networks")
    wanted = F.when(F.col("status") == "merged", "lookups").otherwise("no such/topic")
    lookups = table(spark, d, "merge_candidates").select(F.lit("mac.lookup").alias("topic"), F.col("candidate_id").alias("key"), F.to_json(F.struct(F.upper("mac_a").alias("mac"), wanted.alias("reply_topic"))).alias("value"))
    lone = spark.createDataFrame([("backlog.list", "list", "{}"), ("backlog.prune", "prune", "{}"), ("networks.request", "networks", '{"reply_topic": "_INBOX.sensor"}')], "topic string, key string, value string")

    def backlog(batch: DataFrame) -> dict[str, DataFrame]:
        after, replies, bad = apply_backlog(batch.sparkSession.createDataFrame([], BACKLOG), batch, NOW_US)
        return {"backlog": after, "replies": replies, "dlq": bad}

    handlers = {
        "backlog": backlog, "lookups": lambda batch: {"replies": device_replies(batch, devices, ("lookups",))}, "networks": lambda batch: {"replies": network_replies(batch, networks, ())},
    }

    def handle(batch: DataFrame) -> dict[str, DataFrame]:
        return fan_in(handlers)(service_requests(batch).unionByName(lookups).unionByName(lone))

    drain(stream_of(spark, d, "sync_events"), handle, place, f"{place}/checkpoint")
    return spark.read.parquet(f"{place}/{name}").drop("epoch")


_SAVED = """b AS (SELECT stream_name, dedupe_key, bool_or(status = 'done') AS done, CASE WHEN bool_or(status IN ('pending', 'done')) THEN 'pre_publish' ELSE 'post_publish' END AS stage,
 CASE WHEN bool_or(status = 'pending') THEN '{"dedupe_key":"' || dedupe_key || '","stream_name":"' || stream_name || '"}' WHEN bool_or(status = 'done') THEN '{"dedupe_key":"' || dedupe_key || '","stream_name":"' || stream_name || '","failure_stage":"pre_publish"}' ELSE '{"dedupe_key":"' || dedupe_key || '","stream_name":"' || stream_name || '","failure_stage":"post_publish"}' END AS payload
 FROM sync_events WHERE status IN ('pending', 'failed', 'done') GROUP BY 1, 2)"""


@query("st07_backlog", f"WITH {_SAVED} SELECT stream_name, dedupe_key, CASE WHEN done THEN 'synced' ELSE 'pending' END AS status, stage, payload FROM b")
def backlog_consumer(spark: SparkSession, d: str) -> DataFrame:
    """The backlog after saves and marks, from one stream that feeds all service consumers."""
    return _consume(spark, d, "backlog").select("stream_name", "dedupe_key", "status", "stage", "payload")


@query("st07b_backlog_dead_letters", """
SELECT dedupe_key AS key, 'blank dedupe_key' AS error, 'backlog_save' AS operation FROM sync_events WHERE payload IS NULL AND status = 'batched'""")
def backlog_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    member = lambda c: F.get_json_object("value", f"$.{c}").alias(c)
    return _consume(spark, d, "dlq").select("key", member("error"), member("operation"))


@query("st08_replies", f"""
WITH {_SAVED}, {FRAMES_SQL}, dv AS (SELECT DISTINCT source_mac FROM f), l AS (SELECT * FROM b WHERE NOT done ORDER BY stream_name, dedupe_key LIMIT 100)
SELECT CASE WHEN status = 'merged' THEN 'lookups' ELSE 'lookup.replies' END AS topic, candidate_id AS key, CAST(json_object('device_id', lower(trim(mac_a)), 'username', NULL, 'display_name', 'device ' || right(lower(trim(mac_a)), 5), 'hostname', NULL) AS VARCHAR) AS value
FROM merge_candidates JOIN dv ON dv.source_mac = lower(trim(mac_a)) WHERE regexp_full_match(lower(trim(mac_a)), '[0-9a-f]{{2}}(:[0-9a-f]{{2}}){{5}}')
UNION ALL SELECT 'backlog.replies', 'prune', '{{"pruned":0,"retention_days":7}}'
UNION ALL SELECT 'backlog.replies', 'list', '{{"entries":' || CAST(to_json(list(json_object('dedupe_key', dedupe_key, 'stream_name', stream_name, 'payload', payload, 'failure_stage', stage, 'attempt_count', 0) ORDER BY stream_name, dedupe_key)) AS VARCHAR) || '}}' FROM l
UNION ALL SELECT '_INBOX.sensor', 'networks', CAST(to_json(list(json_object('ssid', ssid, 'bssid', lower(bssid), 'location_id', location_id, 'label', label, 'enabled', enabled) ORDER BY id)) AS VARCHAR) FROM wireless_authorized_networks WHERE enabled""")
def service_replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies of all consumers: lookups, the list, the pruning and the networks, each in an allowed topic."""
    return _consume(spark, d, "replies").select("topic", "key", "value")


@query("st09_probe_flush", f"""
SELECT ssid, client_mac, max(known_bssid) AS known_bssid, min(first_seen) AS first_us, max(last_seen) AS last_us, sum(probe_count) AS probe_count FROM (SELECT * REPLACE (CAST(probe_count AS DOUBLE) AS probe_count) FROM ({sink_sql('probe_requests', records_sql('wireless.probe.flush', 'probes'))})) WHERE error IS NULL GROUP BY 1, 2""")
def probe_flush(spark: SparkSession, d: str) -> DataFrame:
    """Clients after a flush, which is delivered twice: the same batch adds its counts once."""
    place = room(spark, "st09")
    source = stream_of(spark, d, "sync_events").where("stream_name = 'wireless.probe.flush' and payload is not null").select("stream_name", "dedupe_key", "payload", "updated_at")

    def handle(batch: DataFrame) -> dict[str, DataFrame]:
        rows = transform(batch.groupBy("stream_name", "dedupe_key").agg(latest_payload().alias("payload")).where("payload is not null"), "probe_requests")
        none = batch.sparkSession.createDataFrame([], "ssid string, client_mac string, known_bssid string, first_seen timestamp, last_seen timestamp, probe_count long, last_batch string")
        good = rows.where("error is null")
        return {"clients": probe_merge(probe_merge(none, good, "flush-1"), good, "flush-1"), "dlq": rows.where("error is not null").select("dedupe_key", "error")}

    drain(source, handle, place, f"{place}/checkpoint")
    c = spark.read.parquet(f"{place}/clients")
    return c.select("ssid", "client_mac", "known_bssid", F.unix_micros("first_seen").alias("first_us"), F.unix_micros("last_seen").alias("last_us"), F.col("probe_count").cast("double").alias("probe_count"))
