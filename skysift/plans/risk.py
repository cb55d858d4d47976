"""Shadow devices, blocked hosts and access point risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.ids import stable_id
from skysift.functions.mac import epoch_us
from skysift.functions.scores import ap_risk, dns_score, severity
from skysift.operators.match import null_tolerant_anti
from skysift.operators.merge import merge_rows, newer_wins
from skysift.plans.alerts import SIGHTINGS_SQL, made_messages, sightings
from skysift.plans.frames import FRAMES_SQL, deliveries, frames, stable_sql
from skysift.plans.identity import _PAIRS, stored_pairs
from skysift.plans.payloads import messages, records_sql, sink_sql, transform
from skysift.plans.registry import NOW, Registry
from skysift.plans.sinks import alert_rows
from skysift.session import materialize
from skysift.sources.tables import table

query = Registry()
TS = f"timestamp_ntz'{NOW}'"

STRONG, WINDOW_S, PRESENCE_S = -50, 172_800, 518_400
NETWORK_NAMES_SQL = "nn AS (SELECT bssid, max(ssid) AS ssid FROM wireless_authorized_networks WHERE bssid IS NOT NULL GROUP BY 1)"


def network_names(spark: SparkSession, d: str) -> DataFrame:
    """The name of an access point's network, as the authorised networks give it (frames here carry none)."""
    return table(spark, d, "wireless_authorized_networks").where("bssid is not null").groupBy("bssid").agg(F.max("ssid").alias("ssid"))


def shadow_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Strong frames of devices that no authorised network covers, not handled yet and not known of late."""
    f = frames(spark, d, "bssid", "sensor_id", "location_id", "signal_dbm")
    c = f.where(f"observed_at >= {TS} - INTERVAL {WINDOW_S} SECONDS and signal_dbm >= {STRONG}").where(F.col("source_mac").rlike(r"^[0-9a-f]{2}(:[0-9a-f]{2}){5}\z"))
    c = c.join(table(spark, d, "sync_events").where("status = 'done'").select("dedupe_key"), "dedupe_key", "left_anti")
    c = c.join(network_names(spark, d), "bssid", "left")
    c = null_tolerant_anti(c, table(spark, d, "wireless_authorized_networks").where("enabled"), ["location_id", "ssid", "bssid"])
    known = f.where(f"observed_at >= {TS} - INTERVAL {PRESENCE_S} SECONDS and observed_at < {TS} - INTERVAL {WINDOW_S} SECONDS and signal_dbm < -70").select("source_mac")
    return c.join(known, "source_mac", "left_anti").select("dedupe_key", "source_mac", "observed_at", "bssid", "ssid", "sensor_id", "location_id", "signal_dbm").distinct()


#: What an alert takes from its newest candidate, missing values included.
NEWEST = ("bssid", "ssid", "sensor_id", "location_id", "signal_dbm")


def shadow_fold(candidates: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct(*NEWEST), F.struct("observed_at", "dedupe_key"))
    g = candidates.groupBy("source_mac").agg(F.count("*").alias("occurrences"), F.min("observed_at").alias("first"), F.max("observed_at").alias("last"), newest.alias("newest"))
    return g.select("source_mac", "occurrences", "first", "last", *(F.col(f"newest.{c}").alias(c) for c in NEWEST))


_SHADOW = f"""{FRAMES_SQL}, {NETWORK_NAMES_SQL}, c AS (SELECT DISTINCT f.dedupe_key, f.source_mac, f.observed_at, f.bssid, nn.ssid, f.sensor_id, f.location_id, f.signal_dbm FROM f LEFT JOIN nn ON nn.bssid = f.bssid WHERE observed_at >= TIMESTAMP '{NOW}' - INTERVAL {WINDOW_S} SECOND AND signal_dbm >= {STRONG} AND regexp_full_match(source_mac, '[0-9a-f]{{2}}(:[0-9a-f]{{2}}){{5}}')
 AND NOT EXISTS (SELECT 1 FROM sync_events e WHERE e.dedupe_key = f.dedupe_key AND e.status = 'done')
 AND NOT EXISTS (SELECT 1 FROM wireless_authorized_networks n WHERE n.enabled AND (n.location_id IS NULL OR n.location_id = f.location_id) AND (n.ssid IS NULL OR n.ssid = nn.ssid) AND (n.bssid IS NULL OR n.bssid = f.bssid))
 AND NOT EXISTS (SELECT 1 FROM f d WHERE d.source_mac = f.source_mac AND d.observed_at >= TIMESTAMP '{NOW}' - INTERVAL {PRESENCE_S} SECOND AND d.observed_at < TIMESTAMP '{NOW}' - INTERVAL {WINDOW_S} SECOND AND d.signal_dbm < -70)),
a AS (SELECT source_mac, count(*) AS occurrences, min(observed_at) AS first, max(observed_at) AS last, arg_max(struct_pack(bssid := bssid, ssid := ssid, sensor_id := sensor_id, location_id := location_id, signal_dbm := signal_dbm), (observed_at, dedupe_key)) AS x FROM c GROUP BY 1)"""
_SHADOW_OUT = "source_mac, occurrences, epoch_us(first) AS first_us, epoch_us(last) AS last_us, x.bssid AS bssid, x.ssid AS ssid, x.sensor_id AS sensor_id, x.location_id AS location_id, x.signal_dbm AS signal_dbm"


def _shown(alerts: DataFrame) -> DataFrame:
    return alerts.select("source_mac", "occurrences", epoch_us(F.col("first")).alias("first_us"), epoch_us(F.col("last")).alias("last_us"), *NEWEST)


@query("q12_shadow_alerts", f"WITH {_SHADOW} SELECT {_SHADOW_OUT} FROM a")
def shadow_alerts(spark: SparkSession, d: str) -> DataFrame:
    """One alert a device; all candidates are drained at once."""
    return _shown(shadow_fold(shadow_candidates(spark, d)))


@query("q12c_shadow_alert_merge", f"WITH {_SHADOW} SELECT {_SHADOW_OUT} FROM a")
def shadow_alert_merge(spark: SparkSession, d: str) -> DataFrame:
    """Alerts stored from the last day, then merged with those of the day before: counts add up, the newer values stay."""
    c = shadow_candidates(spark, d)
    newer, older = shadow_fold(c.where(f"observed_at >= {TS} - INTERVAL 1 DAY")), shadow_fold(c.where(f"observed_at < {TS} - INTERVAL 1 DAY"))
    rules = {"occurrences": "add", "first": "least", "last": "greatest", **{x: newer_wins(x, "last") for x in NEWEST}}
    return _shown(merge_rows(newer, older, ["source_mac"], rules))


_STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


@query("q12b_shadow_alert_json", f"""
WITH {_SHADOW} SELECT source_mac, CAST(json_object('event_type', 'shadow_device', 'first_occurred_at', strftime(first, {_STAMP}), 'last_occurred_at', strftime(last, {_STAMP}), 'source_mac', source_mac, 'occurrence_count', occurrences, 'destination_bssid', x.bssid, 'ssid', x.ssid,
 'sensor_id', x.sensor_id, 'location_id', x.location_id, 'signal_dbm', x.signal_dbm, 'reason', 'strong_wireless_without_proxy_presence', 'evidence', json_object('window_seconds', {WINDOW_S}, 'signal_threshold_dbm', {STRONG}, 'presence_window_seconds', {PRESENCE_S})) AS VARCHAR) AS alert_json FROM a""")
def shadow_alert_json(spark: SparkSession, d: str) -> DataFrame:
    """Shadow alerts as JSON messages of twelve members; those without a value are kept as null."""
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    body = F.struct(
        F.lit("shadow_device").alias("event_type"), stamp("first").alias("first_occurred_at"), stamp("last").alias("last_occurred_at"), "source_mac", F.col("occurrences").alias("occurrence_count"), F.col("bssid").alias("destination_bssid"), "ssid", "sensor_id", "location_id", "signal_dbm",
        F.lit("strong_wireless_without_proxy_presence").alias("reason"), F.struct(F.lit(WINDOW_S).alias("window_seconds"), F.lit(STRONG).alias("signal_threshold_dbm"), F.lit(PRESENCE_S).alias("presence_window_seconds")).alias("evidence"),
    )
    return shadow_fold(shadow_candidates(spark, d)).select("source_mac", F.to_json(body, {"ignoreNullFields": "false"}).alias("alert_json"))


@query("q21_dns_threat", f"""
WITH {SIGHTINGS_SQL}, p AS (SELECT host, make_timestamp(CAST(event_time AS BIGINT)) AS t, bytes_up + bytes_down AS n FROM ({sink_sql('proxy_events', records_sql('proxy.events'))}) WHERE error IS NULL AND blocked = 1
 UNION ALL SELECT bssid || '.example', CAST(day || ' 12:00:00' AS TIMESTAMP), n * 2 FROM k WHERE n % 2 = 0),
g AS (SELECT host, count(*) AS blocked, CAST(sum(n) AS BIGINT) AS traffic, count(*) FILTER (WHERE t >= TIMESTAMP '{NOW}' - INTERVAL 1 DAY) AS recent, max(t) AS last FROM p WHERE t >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY GROUP BY 1 HAVING count(*) > 1),
z AS (SELECT *, blocked * (traffic / CAST(blocked AS DOUBLE) + 1) * (1 + 2.0 * recent / CAST(blocked AS DOUBLE)) AS score FROM g)
SELECT {stable_sql('dns-threat', 'host')} AS signal_id, 'dns:' || host AS source_key, blocked, traffic, recent, round(score, 3) AS score, CASE WHEN score >= 1000 THEN 'critical' WHEN score >= 500 THEN 'high' WHEN score >= 100 THEN 'medium' ELSE 'low' END AS severity,
 'blocked DNS/host activity exceeded the characterized seven-day score for dns:' || host AS explanation, epoch_us(last) AS detected_us FROM z""")
def dns_threat(spark: SparkSession, d: str) -> DataFrame:
    """Hosts blocked more than once in seven days, scored, as threat signals; stored proxy events and made ones of busy access points."""
    now = F.expr(f"timestamp'{NOW} UTC'")
    columns = ("host", "event_time", "bytes_up", "bytes_down", "blocked", "error")
    stored = transform(messages(spark, d, "proxy.events"), "proxy_events").select(*columns)
    made = transform(made_messages(spark, d, "proxy_events"), "proxy_events").select(*columns)
    b = stored.unionByName(made).where("error is null and blocked = 1").where(F.col("event_time") >= now - F.expr("INTERVAL 7 DAYS"))
    recent = F.count_if(F.col("event_time") >= now - F.expr("INTERVAL 1 DAY")).alias("recent")
    g = b.groupBy("host").agg(F.count("*").alias("blocked"), F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("traffic"), recent, F.max("event_time").alias("last")).where("blocked > 1")
    score, key = dns_score(F.col("blocked"), F.col("traffic"), F.col("recent")), F.concat(F.lit("dns:"), "host")
    text = F.concat(F.lit("blocked DNS/host activity exceeded the characterized seven-day score for "), key)
    return g.select(stable_id("dns-threat", F.col("host")).alias("signal_id"), key.alias("source_key"), "blocked", "traffic", "recent", F.round(score, 3).alias("score"), severity(score).alias("severity"), text.alias("explanation"), F.unix_micros("last").alias("detected_us"))


#: The moment and the window of the access point risk: alerts here carry the first moment of their day.
RISK_NOW, RISK_HOURS, RECENT_APS = "2021-01-21 06:00:00", 24, 1000


@query("q22_entity_risk", f"""
WITH {SIGHTINGS_SQL}, {NETWORK_NAMES_SQL}, {_PAIRS}, x AS (SELECT bssid FROM f WHERE bssid IS NOT NULL GROUP BY 1 ORDER BY max(observed_at) DESC, bssid LIMIT {RECENT_APS}),
al AS (SELECT CASE WHEN n % 2 = 1 THEN mac ELSE bssid END AS bssid, 'deauth_flood' AS t, CAST(day AS TIMESTAMP) AS happened FROM k UNION ALL SELECT CASE WHEN n % 4 = 0 THEN bssid ELSE mac END, 'signal_anomaly', CAST(day AS TIMESTAMP) FROM k WHERE lo IS NOT NULL UNION ALL SELECT bssid, 'rogue_ap', CAST(day AS TIMESTAMP) FROM k),
sc AS (SELECT bssid, max(CAST(t IN ('deauth_flood', 'rogue_cluster') AS INTEGER)) AS de, max(CAST(t IN ('signal_anomaly', 'rogue_cluster') AS INTEGER)) AS si, max(CAST(t = 'rogue_cluster' AS INTEGER)) AS ty FROM al WHERE happened >= TIMESTAMP '{RISK_NOW}' - INTERVAL {RISK_HOURS} HOUR GROUP BY 1),
fr AS (SELECT f.bssid, nn.ssid, upper(replace(left(f.bssid, 8), ':', '')) AS oui FROM f JOIN nn ON nn.bssid = f.bssid WHERE observed_at >= TIMESTAMP '{RISK_NOW}' - INTERVAL {RISK_HOURS} HOUR),
vc AS (SELECT ssid, count(DISTINCT oui) AS n FROM fr GROUP BY 1), vs AS (SELECT fr.bssid, greatest(max(vc.n) - 1, 0) AS ve FROM fr JOIN vc ON vc.ssid = fr.ssid GROUP BY 1),
home AS (SELECT source_mac, max(bssid) AS bssid FROM f WHERE bssid IS NOT NULL GROUP BY 1),
pd AS (SELECT l.bssid AS lb, r.bssid AS rb, cosine_distance AS dist FROM p JOIN home l ON l.source_mac = p.mac_a JOIN home r ON r.source_mac = p.mac_b WHERE cosine_distance > 0.15 AND computed_at >= TIMESTAMP '{RISK_NOW}' - INTERVAL {RISK_HOURS} HOUR),
ou AS (SELECT bssid, max(dist) AS ou FROM (SELECT lb AS bssid, dist FROM pd UNION ALL SELECT rb, dist FROM pd) GROUP BY 1),
b AS (SELECT x.bssid, least(coalesce(de, 0), 1) AS de, least(coalesce(si, 0), 1) AS si, least(coalesce(ty, 0), 1) AS ty, least(coalesce(ve, 0), 1) AS ve, least(coalesce(ou, 0), 1) AS ou FROM x LEFT JOIN sc ON sc.bssid = x.bssid LEFT JOIN vs ON vs.bssid = x.bssid LEFT JOIN ou ON ou.bssid = x.bssid),
z AS (SELECT bssid, CAST(de * 0.25 + si * 0.2 AS DOUBLE) AS signal_risk, CAST(ty * 0.2 + ve * 0.15 AS DOUBLE) AS identity_risk, CAST(ou AS DOUBLE) * 0.2 AS behaviour_risk FROM b)
SELECT bssid, round(signal_risk, 6) AS signal_risk, round(identity_risk, 6) AS identity_risk, round(behaviour_risk, 6) AS behaviour_risk, round(least(signal_risk + identity_risk + behaviour_risk, 1), 6) AS composite_risk FROM z""")
def entity_risk(spark: SparkSession, d: str) -> DataFrame:
    """Access point risk from recent alerts, the vendors under a network's name, and outlying pairs.

    The most recent access points (the limit is the feature) bound every other part by a
    semi-join before it is aggregated. Pairs are attributed to both sides by one explode, each
    side being the access point its device was seen at.
    """
    since = f"timestamp_ntz'{RISK_NOW}' - INTERVAL {RISK_HOURS} HOURS"
    f, seen = deliveries(spark, d, "bssid").where("bssid is not null"), materialize(sightings(spark, d), "sightings")
    aps = f.groupBy("bssid").agg(F.max("observed_at").alias("last")).orderBy(F.desc("last"), "bssid").limit(RECENT_APS).select("bssid")
    rows = None
    for kind in ("deauth_flood", "signal_anomaly", "rogue_ap"):
        a = alert_rows(transform(made_messages(spark, d, kind, seen), kind), kind).select("alert_type", F.coalesce("primary_mac", "secondary_mac").alias("bssid"), F.col("detected_at").cast("timestamp_ntz").alias("at"))
        rows = a if rows is None else rows.unionByName(a)
    either = lambda *kinds: F.max(F.col("alert_type").isin(*kinds).cast("int"))
    scores = rows.where(f"at >= {since}").join(F.broadcast(aps), "bssid", "left_semi").groupBy("bssid").agg(either("deauth_flood", "rogue_cluster").alias("de"), either("signal_anomaly", "rogue_cluster").alias("si"), either("rogue_cluster").alias("ty"))
    named = f.where(f"observed_at >= {since}").join(network_names(spark, d), "bssid").select("bssid", "ssid", F.upper(F.replace(F.left("bssid", F.lit(8)), F.lit(":"), F.lit(""))).alias("oui")).distinct()
    counts = named.where("ssid is not null").groupBy("ssid").agg(F.count_distinct("oui").alias("n"))
    vendor = named.join(F.broadcast(aps), "bssid", "left_semi").join(counts, "ssid").groupBy("bssid").agg(F.greatest(F.max("n") - 1, F.lit(0)).alias("ve"))
    home = f.groupBy("source_mac").agg(F.max("bssid").alias("bssid"))
    side = lambda mac, c: home.select(F.col("source_mac").alias(mac), F.col("bssid").alias(c))
    far = stored_pairs(spark, d).where(f"cosine_distance > 0.15 and computed_at >= {since}").join(side("mac_a", "left"), "mac_a").join(side("mac_b", "right"), "mac_b")
    outlier = far.select(F.explode(F.array("left", "right")).alias("bssid"), "cosine_distance").groupBy("bssid").agg(F.max("cosine_distance").alias("ou"))
    joined = aps.join(scores, "bssid", "left").join(vendor, "bssid", "left").join(outlier, "bssid", "left").na.fill(0)
    risk = ap_risk(F.col("de"), F.col("si"), F.col("ty"), F.col("ve"), F.col("ou"))
    return joined.select("bssid", *(F.round(c, 6).alias(n) for n, c in risk.items()))
