"""Alert, audit and bandwidth sinks over messages made of the frame table, and insert-only writes.

The stored messages hold two of the eight alert kinds. The other payloads are made here from
the sightings of an access point by a sensor on a day, with aliases, numbers as text, local
offsets and missing members, and go through the same transforms as stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.frames import band
from skysift.operators.merge import insert_only, merge_rows
from skysift.operators.spread import width
from skysift.plans.frames import FRAMES_SQL, frames
from skysift.plans.payloads import STREAMS, doubles_sql, messages, records_sql, shown, sink_sql, texts_of, transform
from skysift.plans.registry import Registry
from skysift.plans.sinks import alert_rows, daily_alerts

query = Registry()


def sightings(spark: SparkSession, d: str) -> DataFrame:
    rows = frames(spark, d, "sensor_id", "location_id", "bssid", "signal_dbm", "retry").where("sensor_id is not null and location_id is not null and bssid is not null")
    return rows.groupBy("sensor_id", "location_id", "bssid", F.date_format("observed_at", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"), F.min("signal_dbm").alias("lo"), F.max("signal_dbm").alias("hi"), F.max("source_mac").alias("mac"), F.count_if("retry").alias("retries"),
    )


SIGHTINGS_SQL = f"""{FRAMES_SQL}, s AS (SELECT sensor_id, location_id, bssid, strftime(observed_at, '%Y-%m-%d') AS day, count(*) AS n, min(signal_dbm) AS lo, max(signal_dbm) AS hi, max(source_mac) AS mac, count(*) FILTER (WHERE retry) AS retries
 FROM f WHERE sensor_id IS NOT NULL AND location_id IS NOT NULL AND bssid IS NOT NULL GROUP BY ALL), k AS (SELECT *, concat_ws(':', sensor_id, location_id, bssid, day) AS batch_id FROM s)"""


def _at(clock: str) -> Column:
    return F.concat("day", F.lit(f"T{clock}"))




def _members(kind: str) -> dict[str, Column]:
    """The members of a made payload; nulls are left out of the JSON text."""
    c, even = F.col, F.col("n") % 2 == 0
    place = {"sensor_id": c("sensor_id"), "location_id": c("location_id"), "interface": F.lit("wlan0mon")}
    return {
        "rogue_ap": lambda: {"observed_at": _at("06:30:00+02:00"), **place, "channel": (c("n") % 13 + 1).cast("string"), "bssid": c("bssid"), "ssid": F.when(c("n") % 3 == 0, "").otherwise(F.concat(F.lit("net-"), c("n") % 7)), "signal_dbm": c("hi"), "reasons": F.when(even, F.array(F.lit("drift"), F.lit("bssid_spoofing"))).otherwise(F.array(F.lit("drift")))},
        "deauth_flood": lambda: {"detected_at": _at("00:00:00Z"), **place, "source_mac": F.when(~even, c("mac")), "bssid": c("bssid"), "frame_count": c("n"), "window_secs": F.lit("86400"), "threshold": F.when(even, 5), "signal_dbm": c("lo")},
        "signal_anomaly": lambda: {"detected_at": _at("00:00:00.250Z"), **place, "source_mac": F.when(c("n") % 4 == 0, c("bssid")).otherwise(c("mac")), "bssid": c("bssid"), "channel": F.lit(6), "baseline_dbm": c("lo"), "observed_dbm": c("hi"), "dbm_delta": c("lo") - c("hi"), "configured_delta": F.lit(10.0)},
        "pmf_attack": lambda: {"observed_at": _at("12:00:00Z"), **place, "source_mac": c("mac"), "bssid": c("bssid"), "attack_tag": F.when(c("n") > 3, "sa_query_flood"), "reconnect_window_ms": c("n") * 10},
        "proxy_events": lambda: {"type": F.lit("block"), "host": F.concat("bssid", F.lit(".example")), "time": _at("12:00:00Z"), "bytes_up": c("n"), "bytes_down": c("n").cast("string"), "blocked": even},
        "handshake": lambda: {"detected_at": _at("08:00:00Z"), **place, "bssid": c("bssid"), "client_mac": c("mac"), "signal_dbm": c("hi"), "pmkid": F.concat("bssid", "mac")},
        "proxy_payload_audit": lambda: {"observed_at": _at("10:00:00+00:00"), "host": c("bssid"), "correlation_id": F.concat("sensor_id", "location_id", "day"), "direction": F.when(even, "down"), "byte_offset": F.when(c("n") % 5 > 0, c("n").cast("string")), "method": F.lit("GET"), "status_code": F.lit(200), "path": F.concat(F.lit("/"), c("day")), "is_encrypted": even, "notes": F.lit("")},
        "wireless_bandwidth": lambda: {"window_start": _at("23:30:00-01:00"), "window_end": _at("23:45:00-01:00"), **place, "channel": c("n") % 250, "source_mac": c("mac"), "destination_bssid": c("bssid"), "bytes": c("n") * 100, "frame_count": c("n"), "retry_count": c("retries"), "threshold_exceeded": c("n") % 3 == 0},
        "wireless_audit_frames": lambda: {"event_type": F.lit("frame"), "observed_at": _at("23:59:59.999999+00:00"), **place, "channel": c("n") % 250, "frame_subtype": F.lit("beacon"), "raw_len": c("n").cast("double"), "bssid": c("bssid"), "ssid": F.lit(""), "retry": c("retries") > 0, "protected": c("retries"), "security_flags": F.lit("3"), "tags": F.array(F.lit("a"), F.lit("b")), "username": F.lit("")},
    }[kind]()


#: Made messages go under these stream names, some of them second names.
MADE = {
    "rogue_ap": "wireless.alert.rogue_ap", "deauth_flood": "wireless.deauth_flood", "signal_anomaly": "wireless.signal_anomaly", "pmf_attack": "wireless.alert.pmf_attack",
    "handshake": "wifi.alert.handshake", "proxy_payload_audit": "proxy.payload_audit", "wireless_bandwidth": "audit.wireless.bandwidth", "wireless_audit_frames": "wireless.audit", "proxy_events": "proxy.events",
}


def made_messages(spark: SparkSession, d: str, kind: str, seen: DataFrame | None = None) -> DataFrame:
    """Messages of one kind, from all sightings or those given; spread, because JSON is heavy for its bytes."""
    body = F.to_json(F.struct(*(v.alias(k) for k, v in _members(kind).items())))
    rows = sightings(spark, d) if seen is None else seen
    return rows.repartition(width(rows), "sensor_id", "bssid", "day").select(F.lit(MADE[kind]).alias("stream_name"), F.concat_ws(":", "sensor_id", "location_id", "bssid", "day").alias("dedupe_key"), body.alias("payload"))


def _noted(day: str, clock: str) -> str:
    return f"epoch_us(CAST({day} || 'T{clock}' AS TIMESTAMPTZ))"


_ALERT_SQL = {
    "rogue_ap": (_noted("day", "06:30:00+02:00"), "bssid", "NULL", "CASE WHEN n % 3 > 0 THEN 'net-' || (n % 7) END", "n % 13 + 1", "hi", "json_object('ssid_impersonation', CAST(n % 2 = 0 AS INTEGER))", "true"),
    "deauth_flood": (_noted("day", "00:00:00Z"), "CASE WHEN n % 2 = 1 THEN mac END", "bssid", "NULL", "0", "lo", "json_object('deauth_count', n, 'window_secs', 86400, 'threshold', CASE WHEN n % 2 = 0 THEN 5 ELSE 0 END)", "true"),
    "signal_anomaly": (_noted("day", "00:00:00.250Z"), "CASE WHEN n % 4 = 0 THEN bssid ELSE mac END", "bssid", "NULL", "6", "hi", "json_object('baseline_dbm', lo, 'observed_dbm', hi, 'dbm_delta', hi - lo, 'configured_delta', 10)", "lo IS NOT NULL"),
    "pmf_attack": (_noted("day", "12:00:00Z"), "mac", "bssid", "NULL", "NULL", "NULL", "json_object('attack_tag', 'sa_query_flood', 'reconnect_window_ms', n * 10)", "n > 3"),
    "handshake": (_noted("day", "08:00:00Z"), "mac", "bssid", "NULL", "NULL", "hi", "json_object('pmkid_sha256', sha256(bssid || mac))", "true"),
}


def _alert_sql(kind: str) -> str:
    at, first, second, ssid, channel, signal, details, keep = _ALERT_SQL[kind]
    return f"""WITH {SIGHTINGS_SQL} SELECT '{kind}' AS alert_type, batch_id, 0 AS row_sequence, {at} AS detected_us, sensor_id, location_id, {first} AS primary_mac, {second} AS secondary_mac, {ssid} AS ssid,
 CAST({channel} AS DOUBLE) AS channel, CAST({signal} AS DOUBLE) AS signal_dbm, CAST({details} AS VARCHAR) AS details_json FROM k WHERE {keep}"""


def _alert_query(kind: str) -> None:
    @query(f"q43_{kind}_alerts", _alert_sql(kind))
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = alert_rows(transform(made_messages(spark, d, kind), kind), kind)
        return rows.select("alert_type", "batch_id", "row_sequence", F.unix_micros("detected_at").alias("detected_us"), *(c for c in rows.columns[4:9]), *(F.col(c).cast("double").alias(c) for c in ("channel", "signal_dbm")), "details_json")


for _kind in _ALERT_SQL:
    _alert_query(_kind)


@query("q43g_alert_overwrite", _alert_sql("rogue_ap").replace("CAST(hi AS DOUBLE) AS signal_dbm", "CAST(CASE WHEN n % 2 = 0 THEN hi ELSE -99 END AS DOUBLE) AS signal_dbm"))
def alert_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """The alert table after a second batch of some of its alerts: all but the key is overwritten."""
    rows = alert_rows(transform(made_messages(spark, d, "rogue_ap"), "rogue_ap"), "rogue_ap")
    stored = rows.withColumn("signal_dbm", F.lit(-99).cast("long"))
    again = rows.where(F.get_json_object("details_json", "$.ssid_impersonation") == "1")
    m = merge_rows(stored, again, ["alert_type", "batch_id", "row_sequence"], {})
    return m.select("alert_type", "batch_id", "row_sequence", F.unix_micros("detected_at").alias("detected_us"), *m.columns[4:9], *(F.col(c).cast("double").alias(c) for c in ("channel", "signal_dbm")), "details_json")


@query("q30_proxy_payload_audit", f"""
WITH {SIGHTINGS_SQL} SELECT batch_id AS dedupe_key, sensor_id || location_id || day AS correlation_id, bssid AS host, CASE WHEN n % 2 = 0 THEN 'DOWN' ELSE 'UP' END AS direction, {_noted('day', '10:00:00Z')} AS captured_us,
 CASE WHEN n % 5 > 0 THEN n ELSE 0 END AS byte_offset, 'GET' AS http_method, 200 AS http_status, '/' || day AS http_path, CAST(n % 2 = 0 AS INTEGER) AS is_encrypted FROM k""")
def payload_audit(spark: SparkSession, d: str) -> DataFrame:
    """Audit rows with their five-column key, inserted only where the key is new."""
    rows = transform(made_messages(spark, d, "proxy_payload_audit"), "proxy_payload_audit").where("error is null")
    key = ["correlation_id", "host", "direction", "captured_at", "byte_offset"]
    stored = rows.where("is_encrypted = 1")
    all_ = insert_only(stored, rows, key)
    return all_.select("dedupe_key", "correlation_id", "host", "direction", F.unix_micros("captured_at").alias("captured_us"), "byte_offset", "http_method", "http_status", "http_path", "is_encrypted")


@query("q24_daily_alert_merge", f"""
WITH {SIGHTINGS_SQL}, b AS (SELECT *, CAST(day || 'T23:30:00-01:00' AS TIMESTAMPTZ) AS ws FROM k WHERE n % 3 = 0)
SELECT sensor_id, mac AS source_mac, bssid AS destination_bssid, day AS alert_date, 0 AS row_sequence, epoch_us(min(ws)) AS detected_us, arg_max(location_id, (ws, batch_id)) AS location_id, CAST(sum(n * 100) AS BIGINT) AS total_bytes, count(*) AS aggregated_rows FROM b GROUP BY 1, 2, 3, 4""")
def daily_alert_merge(spark: SparkSession, d: str) -> DataFrame:
    """Bandwidth rows over their threshold, folded to one alert a day; the day is that of the row's own offset."""
    return daily_alerts(transform(made_messages(spark, d, "wireless_bandwidth"), "wireless_bandwidth").where("error is null"))


@query("q24b_daily_alert_upsert", f"""
WITH {SIGHTINGS_SQL}, b AS (SELECT * FROM k WHERE n % 3 = 0)
SELECT sensor_id, mac AS source_mac, bssid AS destination_bssid, day AS alert_date, CAST(sum(n * 100) * 2 AS BIGINT) AS total_bytes FROM b GROUP BY 1, 2, 3, 4""")
def daily_alert_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Bytes of a second batch are added to the alerts of the day; missing bytes count as none."""
    day = daily_alerts(transform(made_messages(spark, d, "wireless_bandwidth"), "wireless_bandwidth").where("error is null"))
    keys = ["sensor_id", "source_mac", "destination_bssid", "alert_date"]
    return merge_rows(day, day, keys, {"total_bytes": "add"}).select(*keys, "total_bytes")


_BAND = "CASE WHEN channel BETWEEN 1 AND 14 THEN '2.4GHz' WHEN channel > 14 AND channel <= 233 THEN '5GHz' ELSE 'unknown' END"


def _insert_query(kind: str) -> None:
    """Typed rows written insert-only by (batch, row): the stored ones stay, a delivery again adds nothing."""
    stream, inner = STREAMS[kind]
    banded = kind in ("wireless_audit_frames", "wireless_bandwidth")
    sql = doubles_sql(sink_sql(kind, records_sql(stream, inner)), texts_of(kind))
    outer = f"SELECT *{f', {_BAND} AS band' if banded else ''} FROM ({sql}) WHERE error IS NULL"

    @query(f"q30b_insert_{kind}", outer)
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = transform(messages(spark, d, stream), kind).where("error is null")
        if banded:
            rows = rows.withColumn("band", band(F.col("channel")))
        stored = rows.where("row_sequence <= 1")
        return shown(insert_only(stored, rows, ["dedupe_key", "row_sequence"]))


for _kind in ("proxy_events", "wireless_bandwidth", "probe_requests"):
    _insert_query(_kind)


@query("q30b_insert_audit_frames", f"""
WITH {SIGHTINGS_SQL} SELECT batch_id AS dedupe_key, {_noted('day', '23:59:59.999999Z')} AS observed_us, n % 250 AS channel, {_BAND.replace('channel', '(n % 250)')} AS band, n AS raw_len, '' AS ssid, CAST(retries > 0 AS INTEGER) AS is_retry,
 CAST(retries <> 0 AS INTEGER) AS is_protected, 0 AS is_handshake, 3 AS security_flags, '["a","b"]' AS tags, NULL AS username, 'unknown' AS identity_source FROM k""")
def insert_audit_frames(spark: SparkSession, d: str) -> DataFrame:
    """Audit frames with the band of their channel, written insert-only; an empty network name is kept, other empty texts are not."""
    rows = transform(made_messages(spark, d, "wireless_audit_frames"), "wireless_audit_frames").where("error is null").withColumn("band", band(F.col("channel")))
    all_ = insert_only(rows.where("is_retry = 1"), rows, ["dedupe_key", "row_sequence"])
    return all_.select("dedupe_key", F.unix_micros("observed_at").alias("observed_us"), "channel", "band", "raw_len", "ssid", "is_retry", "is_protected", "is_handshake", "security_flags", "tags", "username", "identity_source")
