"""Search documents from their sources: events, devices, behaviour windows, sequences; stale windows and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.mac import canonical_mac, epoch_us
from skysift.plans.documents import prepared, token_rows
from skysift.plans.frames import HOUR
from skysift.plans.identity import _CLUSTERS, known_clusters
from skysift.plans.payloads import _AUDIT, _GUARDED, SEARCHED, audit_events, wide
from skysift.plans.problems import canon_sql
from skysift.plans.registry import Registry
from skysift.session import materialize
from skysift.sources.tables import table

query = Registry()

#: The moment up to which stored snapshots, profiles and documents were made.
MADE = "2021-01-18 00:00:00"
MADE_TS, MADE_SQL = f"timestamp_ntz'{MADE}'", f"TIMESTAMP '{MADE}'"


def arrivals(spark: SparkSession, d: str) -> DataFrame:
    """Each frame once, with its first arrival."""
    rows = table(spark, d, "projection_frames").select("dedupe_key", canonical_mac(F.col("source_mac")).alias("source_mac"), "observed_at", "created_at")
    once = rows.groupBy("dedupe_key", "source_mac", "observed_at").agg(F.min("created_at").alias("arrived"))
    return once.withColumn("window_start", F.date_trunc("hour", F.col("observed_at").cast("timestamp")))


def windows(rows: DataFrame) -> DataFrame:
    """Frames, last arrival, key and summary of each source and hour."""
    g = rows.groupBy("source_mac", "window_start").agg(F.count("*").alias("n"), F.max("arrived").alias("updated_at"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.concat(F.col("n"), F.lit(" wireless frames for "), F.col("source_mac"), F.lit(" from "), iso(F.col("window_start")), F.lit(" to "), iso(F.col("window_start") + F.expr("INTERVAL 1 HOUR")))
    return g.withColumn("source_key", F.concat_ws(":", "source_mac", F.unix_seconds("window_start"))).withColumn("text", text)


_ARRIVALS = f"o AS (SELECT dedupe_key, {canon_sql('source_mac')} AS source_mac, observed_at, min(created_at) AS arrived FROM projection_frames GROUP BY ALL), h AS (SELECT *, {HOUR} AS w FROM o)"
_TEXT = "n || ' wireless frames for ' || source_mac || ' from ' || strftime(w, '%Y-%m-%dT%H:%M:%SZ') || ' to ' || strftime(w + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ')"


def _windows_sql(name: str, cond: str) -> str:
    return f"{name} AS (SELECT source_mac || ':' || CAST(epoch_us(w) // 1000000 AS VARCHAR) AS source_key, source_mac, w, n, updated_at, {_TEXT} AS text FROM (SELECT source_mac, w, count(*) AS n, max(arrived) AS updated_at FROM h WHERE {cond} GROUP BY 1, 2))"


_NOW, _OLD = _windows_sql("cur", "true"), _windows_sql("old", f"arrived < {MADE_SQL}")


def stale(rows: DataFrame) -> DataFrame:
    """Windows whose stored profile, made up to a moment, is missing or counts another number of frames."""
    stored = windows(rows.where(f"arrived < {MADE_TS}")).select("source_key", F.col("n").alias("stored_count"))
    return windows(rows).join(stored, "source_key", "left").where("stored_count is null or stored_count <> n")


@query("q07_stale_windows", f"WITH {_ARRIVALS}, {_NOW}, {_OLD} SELECT cur.source_key AS profile_key, cur.n AS source_count, CAST(old.n AS DOUBLE) AS stored_count FROM cur LEFT JOIN old ON old.source_key = cur.source_key WHERE old.n IS NULL OR old.n <> cur.n")
def stale_windows(spark: SparkSession, d: str) -> DataFrame:
    return stale(arrivals(spark, d)).select(F.col("source_key").alias("profile_key"), F.col("n").alias("source_count"), F.col("stored_count").cast("double").alias("stored_count"))


@query("q07d_stale_frames", f"""
WITH {_ARRIVALS}, {_NOW}, {_OLD}, st AS (SELECT cur.source_mac, cur.w FROM cur LEFT JOIN old ON old.source_key = cur.source_key WHERE old.n IS NULL OR old.n <> cur.n)
SELECT h.source_mac, epoch_us(h.w) AS window_us, count(*) AS frames, epoch_us(min(observed_at)) AS first_us, count(*) FILTER (WHERE arrived >= {MADE_SQL}) AS late FROM h JOIN st ON st.source_mac = h.source_mac AND st.w = h.w GROUP BY 1, 2""")
def stale_frames(spark: SparkSession, d: str) -> DataFrame:
    """The frames of stale windows, joined back on source and hour, and folded anew."""
    rows = materialize(arrivals(spark, d), "arrivals")
    again = rows.join(stale(rows).select("source_mac", "window_start"), ["source_mac", "window_start"])
    return again.groupBy("source_mac", "window_start").agg(F.count("*").alias("frames"), epoch_us(F.min("observed_at")).alias("first_us"), F.count_if(F.col("arrived") >= F.expr(MADE_TS)).alias("late")).select("source_mac", epoch_us(F.col("window_start")).alias("window_us"), "frames", "first_us", "late")


_EVENT = ("source_mac", "bssid", "ssid", "frame_subtype", "wps_device_name", "wps_manufacturer", "wps_model_name", "app_protocol", "src_ip", "dst_ip")


@query("q35b_event_documents", f"""
WITH {_AUDIT}, w AS (SELECT dedupe_key, {', '.join(f'{_GUARDED[c]} AS {c}' for c in dict.fromkeys((*SEARCHED, *_EVENT, 'event_type', 'identity_source', 'security_flags')))} FROM e)
SELECT dedupe_key AS source_key, coalesce(nullif(nullif(lower(concat_ws(' ', {', '.join(SEARCHED)})), ''), ''), concat_ws(' ', {', '.join(_EVENT)})) AS text,
 CAST(json_object('dedupe_key', dedupe_key, 'event_type', event_type, 'identity_source', identity_source, 'security_flags', security_flags) AS VARCHAR) AS attributes
FROM w WHERE NOT EXISTS (SELECT 1 FROM sync_events x WHERE x.dedupe_key = w.dedupe_key AND x.status = 'done')""")
def event_documents(spark: SparkSession, d: str) -> DataFrame:
    """Sources of event documents: frames with their identity and security rows, and network rows if any, without an active document.

    Finished messages stand for those with a document.
    """
    names = dict.fromkeys((*SEARCHED, *_EVENT, "event_type", "identity_source", "security_flags", "wireless_search_text"))
    w = materialize(wide(audit_events(spark, d), set(names)), "wide")
    frame = w.select("dedupe_key", "source_mac", "bssid", "ssid", "frame_subtype", "event_type")
    identity = w.select("dedupe_key", "identity_source", "wps_device_name", "wps_manufacturer", "wps_model_name", F.col("wireless_search_text").alias("normalized_text"))
    security, network = w.select("dedupe_key", "security_flags"), w.select("dedupe_key", "app_protocol", "src_ip", "dst_ip")
    active = table(spark, d, "sync_events").where("status = 'done'").select("dedupe_key")
    rows = frame.join(identity, "dedupe_key").join(security, "dedupe_key").join(network, "dedupe_key", "left").join(active, "dedupe_key", "left_anti")
    attributes = F.to_json(F.struct("dedupe_key", "event_type", "identity_source", "security_flags"), {"ignoreNullFields": "false"})
    return rows.select(F.col("dedupe_key").alias("source_key"), F.coalesce(F.nullif("normalized_text", F.lit("")), F.concat_ws(" ", *_EVENT)).alias("text"), attributes.alias("attributes"))


@query("q35d_device_documents", f"""
WITH RECURSIVE {_CLUSTERS} SELECT km.mac AS source_key, concat_ws(' ', 'kind: device', km.mac, kc.cluster_name, 'cluster_size: ' || kc.size) AS text FROM km JOIN kc ON kc.root = km.root
WHERE km.first >= {MADE_SQL} OR {MADE_SQL} < km.last""")
def device_documents(spark: SparkSession, d: str) -> DataFrame:
    """Sources of device documents: inventory with its cluster, where no document exists or it is older than the device.

    Devices seen before the stored moment have a document of that moment.
    """
    whole, known = known_clusters(spark, d)
    text = F.concat_ws(" ", F.lit("kind: device"), "mac", "cluster_name", F.concat(F.lit("cluster_size: "), F.col("size").cast("string")))
    device = known.join(whole.select("root", "cluster_name", "size"), "root", "left").select("mac", "first", F.col("last").alias("updated_at"), text.alias("text"))
    document = known.where(f"first < {MADE_TS}").select("mac", F.expr(MADE_TS).alias("made_at"))
    return device.join(document, "mac", "left").where("made_at is null or made_at < updated_at").select(F.col("mac").alias("source_key"), "text")


def behaviour_sources(rows: DataFrame) -> DataFrame:
    """Windows without a document, or with one older than their last frame's arrival, and a text."""
    document = windows(rows.where(f"arrived < {MADE_TS}")).select("source_key", F.col("updated_at").alias("made_at"))
    return windows(rows).join(document, "source_key", "left").where("(made_at is null or made_at < updated_at) and text <> ''")


_BEHAVIOUR = f"{_ARRIVALS}, {_NOW}, {_OLD}, b AS (SELECT cur.source_key, cur.text FROM cur LEFT JOIN old ON old.source_key = cur.source_key WHERE old.updated_at IS NULL OR old.updated_at < cur.updated_at)"


@query("q35c_behaviour_documents", f"WITH {_BEHAVIOUR} SELECT * FROM b")
def behaviour_documents(spark: SparkSession, d: str) -> DataFrame:
    return behaviour_sources(arrivals(spark, d)).select("source_key", "text")


_SEQUENCE = f"""q AS (SELECT session_key AS source_key, array_to_string(list_filter(tokens, lambda t: t <> ''), ' ') AS text, window_start, window_end FROM (SELECT session_key, arg_max(tokens, (window_end, len(tokens))) AS tokens, max(window_start) AS window_start, max(window_end) AS window_end FROM frame_sequences WHERE tokens IS NOT NULL GROUP BY 1))"""


@query("q35e_sequence_documents", f"WITH {_SEQUENCE} SELECT source_key, text FROM q WHERE text <> '' AND (window_end >= {MADE_SQL} OR window_start + INTERVAL 5 MINUTE < window_end)")
def sequence_documents(spark: SparkSession, d: str) -> DataFrame:
    """Sources of sequence documents; sessions that ended before the stored moment have a document made five minutes after they began."""
    s = table(spark, d, "frame_sequences").where("tokens is not null").groupBy("session_key").agg(F.max_by("tokens", F.struct("window_end", F.size("tokens"))).alias("tokens"), F.max("window_start").alias("begin"), F.max("window_end").alias("end"))
    text = F.array_join(F.filter("tokens", lambda t: t != ""), " ")
    made = F.when(F.col("end") < F.expr(MADE_TS), F.col("begin") + F.expr("INTERVAL 5 MINUTES"))
    return s.select(F.col("session_key").alias("source_key"), text.alias("text"), "end", made.alias("made_at")).where("text <> '' and (made_at is null or made_at < end)").select("source_key", "text")


@query("q35f_documents_by_kind", f"""
WITH RECURSIVE {_CLUSTERS}, {_BEHAVIOUR}, {_SEQUENCE} SELECT 'behaviour_window' AS kind, count(*) AS n FROM b UNION ALL SELECT 'frame_sequence', count(*) FROM q WHERE text <> '' AND (window_end >= {MADE_SQL} OR window_start + INTERVAL 5 MINUTE < window_end)
UNION ALL SELECT 'device', count(*) FROM km WHERE first >= {MADE_SQL} OR {MADE_SQL} < last""")
def documents_by_kind(spark: SparkSession, d: str) -> DataFrame:
    """How many documents of each kind are due: the kinds as one union."""
    kinds = {"behaviour_window": behaviour_documents, "frame_sequence": sequence_documents, "device": device_documents}
    parts = [f(spark, d).select(F.lit(k).alias("kind")) for k, f in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("kind").agg(F.count("*").alias("n"))


def upsert_documents(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored documents after an upsert of fresh ones: other active documents of a fresh one's source become superseded."""
    sources = fresh.select("source_table", "source_key", F.lit(True).alias("renewed")).distinct()
    kept = stored.join(fresh.select("document_id"), "document_id", "left_anti").join(sources, ["source_table", "source_key"], "left")
    status = F.when(F.col("renewed") & (F.col("status") == "active"), "superseded").otherwise(F.col("status"))
    return kept.withColumn("status", status).select(*stored.columns).unionByName(fresh.withColumn("status", F.lit("active")).select(*stored.columns))


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = materialize(arrivals(spark, d), "arrivals")
    source = lambda w: prepared(w.select(F.lit("behaviour_snapshots").alias("source_table"), "source_key", "text"))
    return source(windows(rows.where(f"arrived < {MADE_TS}"))).withColumn("status", F.lit("active")), source(behaviour_sources(rows))


_VERSIONS = f"{_BEHAVIOUR}, od AS (SELECT source_key, text, sha256(lower(text)) AS digest FROM old), nd AS (SELECT source_key, text, sha256(lower(text)) AS digest FROM b)"


@query("q34b_document_upsert", f"""
WITH {_VERSIONS} SELECT source_key, digest AS normalized_sha256, 'active' AS status FROM nd
UNION ALL SELECT source_key, digest, CASE WHEN EXISTS (SELECT 1 FROM nd WHERE nd.source_key = od.source_key) THEN 'superseded' ELSE 'active' END FROM od WHERE NOT EXISTS (SELECT 1 FROM nd WHERE nd.source_key = od.source_key AND nd.digest = od.digest)""")
def document_upsert(spark: SparkSession, d: str) -> DataFrame:
    stored, fresh = _versions(spark, d)
    return upsert_documents(stored, fresh).select("source_key", "normalized_sha256", "status")


@query("q34c_token_replacement", f"""
WITH {_VERSIONS}, a AS (SELECT source_key, digest, text FROM nd UNION ALL SELECT source_key, digest, text FROM od WHERE NOT EXISTS (SELECT 1 FROM nd WHERE nd.source_key = od.source_key AND nd.digest = od.digest)),
x AS (SELECT source_key, digest, unnest(regexp_extract_all(lower(text), '[a-z0-9][a-z0-9:_./-]{{0,190}}')) AS token FROM a) SELECT token, count(*) AS postings, count(DISTINCT source_key || digest) AS documents FROM x GROUP BY 1""")
def token_replacement(spark: SparkSession, d: str) -> DataFrame:
    """Postings after the tokens of upserted documents are deleted and inserted anew."""
    stored, fresh = _versions(spark, d)
    tokens = token_rows(stored.join(fresh.select("document_id"), "document_id", "left_anti")).unionByName(token_rows(fresh))
    return tokens.groupBy("token").agg(F.sum("count").alias("postings"), F.count("*").alias("documents"))
