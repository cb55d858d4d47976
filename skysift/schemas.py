"""Declared schemas of the stored tables, and the check that replaces inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = {
    "projection_frames": "dedupe_key string, source_mac string, location_id string, sensor_id string, observed_at timestamp_ntz, frame_type string, frame_subtype string, signal_dbm int, retry boolean, protected boolean, bssid string, app_protocol string, adjacent_mac_hint string, tsft_delta_us bigint, wall_clock_delta_ms bigint, session_key string, created_at timestamp_ntz",
    "frame_sequences": "session_key string, source_mac string, location_id string, sensor_id string, window_start timestamp_ntz, window_end timestamp_ntz, tokens array<string>, projection_run_id string",
    "timing_profiles": "profile_key string, source_mac string, sensor_id string, location_id string, window_start timestamp_ntz, window_end timestamp_ntz, tsft_p50 double, tsft_p95 double, tsft_jitter double, wall_p50 double, wall_jitter double, source_event_count bigint, projection_run_id string",
    "sync_events": "dedupe_key string, stream_name string, observed_at timestamp_ntz, payload_ref string, payload string, payload_sha256 string, status string, attempt_count int, last_error string, producer string, event_kind string, created_at timestamp_ntz, updated_at timestamp_ntz",
    "broker_records": "delivery_id bigint, topic string, partition_id int, record_offset bigint, consumer_group string, group_version int, message_key string, payload_sha256 string, stream_name string, dedupe_key string, batch_id string, received_at timestamp_ntz",
    "similarity_pairs": "pair_id string, pair_kind string, embedding_kind string, left_source_mac string, left_sensor_id string, left_observed_at timestamp_ntz, right_source_mac string, right_sensor_id string, right_observed_at timestamp_ntz, cosine_distance double, cosine_similarity double, pair_rank int, computed_at timestamp_ntz",
    "merge_candidates": "candidate_id string, mac_a string, mac_b string, confidence double, computed_at timestamp_ntz, status string, expires_at timestamp_ntz",
    "wireless_authorized_networks": "id bigint, ssid string, bssid string, location_id string, label string, enabled boolean, created_at timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, sensor_id string, observed_at timestamp_ntz",
    "eval_items": "item_id bigint, text string",
}


def declared(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def problems(df: DataFrame, name: str) -> list[str]:
    """What keeps ``df`` from being table ``name``: missing columns and other types. Extra columns are fine."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [f"{f.name}: {have.get(f.name, 'missing')}, not {f.dataType.simpleString()}" for f in declared(name).fields if have.get(f.name) != f.dataType.simpleString()]


def preflight(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Problems of the declared tables of a data set, by table; empty if all fit."""
    out = {}
    for name in TABLES:
        try:
            found = problems(spark.read.parquet(f"{root}/{name}.parquet"), name)
        except Exception as e:
            found = [str(e).splitlines()[0][:200]]
        if found:
            out[name] = found
    return out
