"""Upsert sinks: roll-ups, inventories and insert-only tables with their merge rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.mac import epoch_us
from skysift.operators.merge import add_unless, insert_only, merge_rows, newer_wins
from skysift.plans.frames import FRAMES_SQL, deliveries, frames
from skysift.plans.payloads import _TEXT, messages, records_sql, sink_sql, transform
from skysift.plans.registry import Registry
from skysift.sources.tables import table

query = Registry()
SPLIT = "timestamp_ntz'2021-01-15 00:00:00'"
SPLIT_SQL = "TIMESTAMP '2021-01-15 00:00:00'"


# Columns of which the last value given counts.
ROLLED = ("risk_score", "category", "frequency_hz", "iat_ms", "tls_ver", "alpn", "ja3_lite", "resolved_ip", "asn_org")


def rollup(blocked: DataFrame) -> DataFrame:
    """Blocked-host roll-up of ``blocked`` rows in the order (event_time, dedupe_key, row_sequence).

    consecutive_blocks is the last value given plus the rows after it; null before the first
    value. No host is sorted: the last given value is a maximum, the rows after it are counted
    in a second aggregate that, like the first, combines before the shuffle.
    """
    order = F.struct("event_time", "dedupe_key", "row_sequence")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    first = blocked.groupBy("host").agg(
        F.count("*").alias("attempts"), F.sum("blocked_bytes").alias("blocked_bytes"), F.sum("tarpit_held_ms").alias("tarpit_held_ms"), *(last(c) for c in (*ROLLED, "consecutive_blocks")),
        F.max(F.when(F.col("consecutive_blocks").isNotNull(), order)).alias("given"), F.max_by(F.coalesce("last_verdict", "verdict"), order).alias("last_verdict"),
    )
    after = blocked.withColumn("at", order).select("host", "at").join(first.select("host", "given"), "host").where("at > given").groupBy("host").agg(F.count("*").alias("after"))
    return first.join(after, "host", "left").withColumn("consecutive_blocks", F.col("consecutive_blocks") + F.coalesce("after", F.lit(0))).drop("given", "after")


_BLOCKED = f"b AS (SELECT * FROM ({sink_sql('blocked_events', records_sql('proxy.events'))}) WHERE error IS NULL)"


@query("q23_rollup_fold", f"""
WITH {_BLOCKED}, k AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY event_time, dedupe_key, row_sequence) AS k FROM b)
SELECT host, count(*) AS attempts, CAST(sum(blocked_bytes) AS BIGINT) AS blocked_bytes, CAST(sum(tarpit_held_ms) AS BIGINT) AS tarpit_held_ms, CAST(arg_max(consecutive_blocks, k) FILTER (WHERE consecutive_blocks IS NOT NULL) + max(k) - max(k) FILTER (WHERE consecutive_blocks IS NOT NULL) AS DOUBLE) AS consecutive_blocks,
 arg_max(coalesce(last_verdict, verdict), k) AS last_verdict, {', '.join(f"{f'CAST(arg_max({c}, k) FILTER (WHERE {c} IS NOT NULL) AS DOUBLE)' if c in ('risk_score', 'frequency_hz', 'iat_ms') else f'arg_max({c}, k) FILTER (WHERE {c} IS NOT NULL)'} AS {c}" for c in ROLLED)} FROM k GROUP BY host""")
def rollup_fold(spark: SparkSession, d: str) -> DataFrame:
    b = transform(messages(spark, d, "proxy.events"), "blocked_events").where("error is null")
    numbers = ("consecutive_blocks", "risk_score", "frequency_hz", "iat_ms")
    return rollup(b).select("host", "attempts", "blocked_bytes", "tarpit_held_ms", "last_verdict", *(F.col(c).cast("double").alias(c) if c in numbers else F.col(c) for c in ("consecutive_blocks", *ROLLED)))


def daily_alerts(rows: DataFrame) -> DataFrame:
    """Bandwidth rows over their threshold as one alert by sensor, source, access point and day of the rows' own offset."""
    over = rows.where("threshold_exceeded <> 0")
    return over.groupBy("sensor_id", "source_mac", "destination_bssid", F.col("window_day").alias("alert_date")).agg(
        F.min("row_sequence").alias("row_sequence"), F.unix_micros(F.min("window_start")).alias("detected_us"), F.max_by("location_id", F.struct("window_start", "dedupe_key", "row_sequence")).alias("location_id"),
        F.sum("bytes").alias("total_bytes"), F.count("*").alias("aggregated_rows"),
    )


@query("q25_earliest_wins", f"WITH {FRAMES_SQL} SELECT sensor_id, arg_min(location_id, (observed_at, dedupe_key)) AS location_id, epoch_us(min(observed_at)) AS last_seen_us FROM f WHERE sensor_id IS NOT NULL AND location_id IS NOT NULL GROUP BY 1")
def earliest_wins(spark: SparkSession, d: str) -> DataFrame:
    """The sensor table takes place and last_seen from a batch's earliest row, as its rule says."""
    rows = deliveries(spark, d, "sensor_id", "location_id").where("sensor_id is not null and location_id is not null")
    return rows.groupBy("sensor_id").agg(F.min_by("location_id", F.struct("observed_at", "dedupe_key")).alias("location_id"), epoch_us(F.min("observed_at")).alias("last_seen_us"))


def device_batch(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_mac").agg(*(F.max(F.nullif(c, F.lit(""))).alias(c) for c in ("location_id", "app_protocol")), F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"), F.lit(1).cast("long").alias("entity_version"))


@query("q26_inventory_upsert", f"""
WITH {FRAMES_SQL}, o AS (SELECT source_mac, max(location_id) AS l, max(nullif(app_protocol, '')) AS a, min(observed_at) AS f, max(observed_at) AS s FROM f WHERE observed_at < {SPLIT_SQL} GROUP BY 1),
n AS (SELECT source_mac, max(location_id) AS l, max(nullif(app_protocol, '')) AS a, min(observed_at) AS f, max(observed_at) AS s FROM f WHERE observed_at >= {SPLIT_SQL} GROUP BY 1)
SELECT coalesce(o.source_mac, n.source_mac) AS mac_id, coalesce(n.l, o.l) AS location_id, coalesce(n.a, o.a) AS app_protocol, epoch_us(least(o.f, n.f)) AS first_us, epoch_us(greatest(o.s, n.s)) AS last_us,
 CASE WHEN o.source_mac IS NOT NULL AND n.source_mac IS NOT NULL THEN 2 ELSE 1 END AS entity_version FROM o FULL JOIN n ON o.source_mac = n.source_mac""")
def inventory_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = deliveries(spark, d, "location_id", "app_protocol")
    old, new = device_batch(rows.where(f"observed_at < {SPLIT}")), device_batch(rows.where(f"observed_at >= {SPLIT}"))
    rules = {"location_id": "coalesce_new", "app_protocol": "coalesce_new", "first_seen": "least", "last_seen": "greatest", "entity_version": "add"}
    m = merge_rows(old, new, ["source_mac"], rules)
    return m.select(F.col("source_mac").alias("mac_id"), "location_id", "app_protocol", epoch_us(F.col("first_seen")).alias("first_us"), epoch_us(F.col("last_seen")).alias("last_us"), "entity_version")


def client_batch(rows: DataFrame) -> DataFrame:
    """Clients of named networks, the name being that of the access point's authorised network."""
    named = rows.where("ssid is not null")
    return named.groupBy("ssid", F.col("source_mac").alias("client_mac")).agg(F.max("bssid").alias("known_bssid"), F.max("location_id").alias("location_id"), F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"), F.count("*").alias("probe_count"), F.lit("b1").alias("last_batch"))


def _half(name: str, cond: str) -> str:
    return f"{name} AS (SELECT n.ssid, source_mac AS client_mac, max(f.bssid) AS b, max(f.location_id) AS l, min(observed_at) AS f, max(observed_at) AS s, count(*) AS n FROM f JOIN nn n ON n.bssid = f.bssid WHERE n.ssid IS NOT NULL AND observed_at {cond} {SPLIT_SQL} GROUP BY 1, 2)"


@query("q27_probe_merge", f"""
WITH {FRAMES_SQL}, nn AS (SELECT bssid, max(ssid) AS ssid FROM wireless_authorized_networks WHERE bssid IS NOT NULL GROUP BY 1), {_half('o', '<')}, {_half('n', '>=')}
SELECT coalesce(o.ssid, n.ssid) AS ssid, coalesce(o.client_mac, n.client_mac) AS client_mac, coalesce(n.b, o.b) AS known_bssid, coalesce(n.l, o.l) AS location_id, epoch_us(least(o.f, n.f)) AS first_us, epoch_us(greatest(o.s, n.s)) AS last_us, coalesce(o.n, 0) + coalesce(n.n, 0) AS probe_count
FROM o FULL JOIN n ON o.ssid = n.ssid AND o.client_mac = n.client_mac""")
def probe_merge(spark: SparkSession, d: str) -> DataFrame:
    """Two batches, the second delivered twice: counts are added once, as its mark is the same."""
    names = table(spark, d, "wireless_authorized_networks").where("bssid is not null").groupBy("bssid").agg(F.max("ssid").alias("ssid"))
    rows = frames(spark, d, "location_id", "bssid").where("bssid is not null").join(names, "bssid")
    old, new = client_batch(rows.where(f"observed_at < {SPLIT}")), client_batch(rows.where(f"observed_at >= {SPLIT}")).withColumn("last_batch", F.lit("b2"))
    rules = {"known_bssid": "coalesce_new", "location_id": "coalesce_new", "first_seen": "least", "last_seen": "greatest", "probe_count": add_unless("last_batch")}
    keys = ["ssid", "client_mac"]
    m = merge_rows(merge_rows(old, new, keys, rules), new, keys, rules)
    return m.select(*keys, "known_bssid", "location_id", epoch_us(F.col("first_seen")).alias("first_us"), epoch_us(F.col("last_seen")).alias("last_us"), "probe_count")


@query("q42_monotone_merge", """
SELECT topic, partition_id, min(received_at) AS first_seen, max(received_at) AS last_seen, coalesce(max(record_offset) FILTER (WHERE group_version = 3), max(record_offset)) AS last_offset FROM broker_records GROUP BY 1, 2""")
def monotone_merge(spark: SparkSession, d: str) -> DataFrame:
    """Partitions as two consumer versions saw them: times merge monotonously, the offset is overwritten."""
    b = table(spark, d, "broker_records")
    fold = lambda x: x.groupBy("topic", "partition_id").agg(F.min("received_at").alias("first_seen"), F.max("received_at").alias("last_seen"), F.max("record_offset").alias("last_offset"))
    return merge_rows(fold(b.where("group_version <> 3")), fold(b.where("group_version = 3")), ["topic", "partition_id"], {"first_seen": "least", "last_seen": "greatest"})


@query("q42b_newer_wins", f"""
WITH {FRAMES_SQL} SELECT source_mac, arg_max(signal_dbm, (observed_at, dedupe_key)) FILTER (WHERE signal_dbm IS NOT NULL) AS signal_dbm, epoch_us(max(observed_at) FILTER (WHERE signal_dbm IS NOT NULL)) AS last_us, count(*) FILTER (WHERE signal_dbm IS NOT NULL) AS n FROM f GROUP BY 1 HAVING n > 0""")
def newer_wins_merge(spark: SparkSession, d: str) -> DataFrame:
    """Later rows are merged first, earlier ones after: the newer values stay."""
    rows = frames(spark, d, "signal_dbm").where("signal_dbm is not null")
    fold = lambda x: x.groupBy("source_mac").agg(F.max_by("signal_dbm", F.struct("observed_at", "dedupe_key")).alias("signal_dbm"), F.max("observed_at").alias("last_seen"), F.count("*").alias("n"))
    m = merge_rows(fold(rows.where(f"observed_at >= {SPLIT}")), fold(rows.where(f"observed_at < {SPLIT}")), ["source_mac"], {"signal_dbm": newer_wins("signal_dbm", "last_seen"), "last_seen": "greatest", "n": "add"})
    return m.select("source_mac", "signal_dbm", epoch_us(F.col("last_seen")).alias("last_us"), "n")


@query("q43_insert_only_merge", """
SELECT stream_name, dedupe_key, coalesce(min(status) FILTER (WHERE observed_at < TIMESTAMP '2021-01-15'), min(status)) AS status FROM sync_events GROUP BY 1, 2""")
def insert_only_merge(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "sync_events")
    fold = lambda x: x.groupBy("stream_name", "dedupe_key").agg(F.min("status").alias("status"))
    return insert_only(fold(e.where("observed_at < timestamp_ntz'2021-01-15'")), fold(e), ["stream_name", "dedupe_key"])


@query("q43b_backlog_states", f"""
SELECT stream_name, dedupe_key, CASE WHEN bool_or(status = 'done') THEN 'synced' WHEN bool_or(status = 'failed') THEN 'sync_failed' ELSE 'pending' END AS backlog_status, max(attempt_count) AS attempts FROM sync_events GROUP BY 1, 2""")
def backlog_states(spark: SparkSession, d: str) -> DataFrame:
    """Backlog status per message; synced is final whatever comes later."""
    done, failed = F.bool_or(F.col("status") == "done"), F.bool_or(F.col("status") == "failed")
    return table(spark, d, "sync_events").groupBy("stream_name", "dedupe_key").agg(F.when(done, "synced").when(failed, "sync_failed").otherwise("pending").alias("backlog_status"), F.max("attempt_count").alias("attempts"))


def backlog_save(backlog: DataFrame, batch: DataFrame) -> DataFrame:
    """Payload and stage of (dedupe_key, stream_name) are overwritten; a synced entry stays synced."""
    keep = lambda old, new: F.when(old == "synced", old).otherwise(new)
    return merge_rows(backlog, batch, ["dedupe_key", "stream_name"], {"status": keep, "attempts": "keep", "last_error": "keep", "next_attempt_us": "keep"})


def backlog_synced(backlog: DataFrame, keys: DataFrame) -> DataFrame:
    marks = keys.select("dedupe_key", "stream_name").distinct().withColumn("mark", F.lit(True))
    return backlog.join(marks, ["dedupe_key", "stream_name"], "left").withColumn("status", F.when(F.col("mark"), F.lit("synced")).otherwise(F.col("status"))).select(*backlog.columns)


def backlog_failed(backlog: DataFrame, errors: DataFrame, now_us: int, delay_us: int) -> DataFrame:
    """Pending and failed entries get the error, one more attempt and their next time."""
    marks = errors.select("dedupe_key", "stream_name", F.col("error").alias("new_error")).dropDuplicates(["dedupe_key", "stream_name"])
    hit = F.col("new_error").isNotNull() & F.col("status").isin("pending", "sync_failed")
    changed = {"status": F.lit("sync_failed"), "attempts": F.col("attempts") + 1, "last_error": F.col("new_error"), "next_attempt_us": F.lit(now_us + delay_us)}
    joined = backlog.join(marks, ["dedupe_key", "stream_name"], "left")
    return joined.select(*(F.when(hit, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in backlog.columns))


def backlog_prune(backlog: DataFrame, before_us: int) -> DataFrame:
    """Without synced entries older than ``before_us``."""
    return backlog.where(~((F.col("status") == "synced") & (F.col("saved_us") < before_us)))


# Alert types, the columns that become the first and second address, and the details kept.
ALERTS = {
    "attack_sequence": (None, None, ("attack_chain", "first_event_at", "last_event_at", "factor_breakdown", "explanation")),
    "sequence_alert": ("source_mac", "bssid", ("session_key", "attack_tag", "sequence", "first_event_at", "last_event_at", "factor_breakdown", "explanation")),
    "rogue_ap": ("rogue_bssid", None, ("ssid_impersonation",)),
    "deauth_flood": ("attacker_mac", "target_bssid", ("deauth_count", "window_secs", "threshold")),
    "signal_anomaly": ("source_mac", "bssid", ("baseline_dbm", "observed_dbm", "dbm_delta", "configured_delta")),
    "pmf_attack": ("target_mac", "target_bssid", ("attack_tag", "reconnect_window_ms")),
    "handshake": ("client_mac", "bssid", ("pmkid_sha256",)),
}


def alert_rows(rows: DataFrame, kind: str) -> DataFrame:
    """Rows of the common alert table from the typed rows of one alert sink.

    Details drop absent members; arrays stay JSON, times are written in UTC.
    """
    first, second, details = ALERTS[kind]
    none = F.lit(None).cast("string")
    member = lambda c: F.try_parse_json(c).alias(c) if c in ("attack_chain", "factor_breakdown", "explanation", "sequence") else F.col(c).alias(c)
    pick = lambda c, kind_: F.col(c) if c in rows.columns else F.lit(None).cast(kind_)
    return rows.where("error is null").select(
        F.lit(kind).alias("alert_type"), F.col("dedupe_key").alias("batch_id"), "row_sequence", "detected_at", "sensor_id", "location_id", F.col(first).alias("primary_mac") if first else none.alias("primary_mac"),
        F.col(second).alias("secondary_mac") if second else none.alias("secondary_mac"), pick("ssid", "string").alias("ssid"), pick("channel", "long").alias("channel"),
        (F.col("observed_dbm") if kind == "signal_anomaly" else pick("signal_dbm", "long")).alias("signal_dbm"), F.to_json(F.struct(*map(member, details))).alias("details_json"),
    )


@query("q43c_alert_table", f"""
WITH {records_sql('wireless.alert.sequence')} SELECT 'sequence_alert' AS alert_type, dedupe_key AS batch_id, CAST(i - 1 AS BIGINT) AS row_sequence, {_TEXT.format('source_mac')} AS primary_mac, {_TEXT.format('session_key')} AS session_key, {_TEXT.format('attack_tag')} AS attack_tag
FROM r WHERE {_TEXT.format('session_key')} IS NOT NULL AND {_TEXT.format('attack_tag')} IS NOT NULL AND {_TEXT.format('sensor_id')} IS NOT NULL AND {_TEXT.format('location_id')} IS NOT NULL
 AND TRY_CAST(json_extract_string(payload, '$.detected_at') AS TIMESTAMPTZ) IS NOT NULL AND TRY_CAST(json_extract_string(payload, '$.first_event_at') AS TIMESTAMPTZ) IS NOT NULL AND TRY_CAST(json_extract_string(payload, '$.last_event_at') AS TIMESTAMPTZ) IS NOT NULL""")
def alert_table(spark: SparkSession, d: str) -> DataFrame:
    a = alert_rows(transform(messages(spark, d, "wireless.alert.sequence"), "sequence_alert"), "sequence_alert")
    return a.select("alert_type", "batch_id", "row_sequence", "primary_mac", F.get_json_object("details_json", "$.session_key").alias("session_key"), F.get_json_object("details_json", "$.attack_tag").alias("attack_tag"))


@query("q43d_attack_alerts", f"""
SELECT 'attack_sequence' AS alert_type, dedupe_key AS batch_id, row_sequence, detected_at AS detected_us, sensor_id, location_id, nullif(ssid, '') AS ssid, attack_chain AS chain, factor_breakdown AS factors, explanation AS reasons, first_event_at AS first_us, last_event_at AS last_us
FROM ({sink_sql('attack_sequence', records_sql('wireless.alert.attack_sequence'))}) WHERE error IS NULL""")
def attack_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Attack alerts; the details' arrays are shown by their size, their times in microseconds."""
    a = alert_rows(transform(messages(spark, d, "wireless.alert.attack_sequence"), "attack_sequence"), "attack_sequence")
    size = lambda c: F.json_array_length(F.get_json_object("details_json", f"$.{c}")).cast("double")
    when = lambda c: F.unix_micros(F.get_json_object("details_json", f"$.{c}").cast("timestamp"))
    return a.select(
        "alert_type", "batch_id", "row_sequence", F.unix_micros("detected_at").alias("detected_us"), "sensor_id", "location_id", F.nullif("ssid", F.lit("")).alias("ssid"), size("attack_chain").alias("chain"), size("factor_breakdown").alias("factors"),
        size("explanation").alias("reasons"), when("first_event_at").alias("first_us"), when("last_event_at").alias("last_us"),
    )


@query("q43e_client_inventory_merge", f"""
SELECT sensor_id, snapshot_at AS snapshot_us, client_mac, min(first_seen) AS first_us, max(last_seen) AS last_us,
 coalesce(arg_max(coalesce(ssid, '-'), (last_seen, dedupe_key, row_sequence)) FILTER (WHERE row_sequence % 2 = 1), arg_max(coalesce(ssid, '-'), (last_seen, dedupe_key, row_sequence))) AS ssid
FROM ({sink_sql('client_inventory', records_sql('wireless.client.inventory', 'clients'))}) WHERE error IS NULL GROUP BY 1, 2, 3""")
def client_inventory_merge(spark: SparkSession, d: str) -> DataFrame:
    """Inventory snapshots merged in two batches: first seen least, last seen greatest, the rest overwritten."""
    rows = transform(messages(spark, d, "wireless.client.inventory"), "client_inventory").where("error is null")
    keys = ["sensor_id", "snapshot_at", "client_mac"]
    fold = lambda x: x.groupBy(*keys).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.max_by(F.coalesce("ssid", F.lit("-")), F.struct("last_seen", "dedupe_key", "row_sequence")).alias("ssid"))
    m = merge_rows(fold(rows.where("row_sequence % 2 = 0")), fold(rows.where("row_sequence % 2 = 1")), keys, {"first_seen": "least", "last_seen": "greatest", "ssid": "overwrite"})
    return m.select("sensor_id", F.unix_micros("snapshot_at").alias("snapshot_us"), "client_mac", F.unix_micros("first_seen").alias("first_us"), F.unix_micros("last_seen").alias("last_us"), "ssid")
