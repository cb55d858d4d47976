"""Windows, sequences, transitions and baselines over projection frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skysift.functions.frames import MANAGEMENT, SPELLINGS, TOKENS, band, frame_token
from skysift.functions.ids import stable_id
from skysift.functions.mac import canonical_mac, epoch_us
from skysift.operators.pairs import neighbour_counts
from skysift.plans.problems import canon_sql
from skysift.plans.registry import Registry
from skysift.sources.tables import table

query = Registry()

COLUMNS = ("dedupe_key", "location_id", "sensor_id", "observed_at", "frame_type", "frame_subtype", "signal_dbm", "retry", "protected", "bssid", "app_protocol", "adjacent_mac_hint", "tsft_delta_us", "wall_clock_delta_ms", "session_key")


def deliveries(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Frames as delivered, copies included, for least, greatest and distinct values, which copies do not change."""
    rows = table(spark, d, "projection_frames").select("dedupe_key", canonical_mac(F.col("source_mac")).alias("source_mac"), "observed_at", *(c for c in columns if c not in ("dedupe_key", "source_mac", "observed_at")))
    return rows.withColumn("window_start", F.date_trunc("hour", F.col("observed_at").cast("timestamp")))


def frames(spark: SparkSession, d: str, *columns: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Each frame once, with its canonical source_mac and the start of its UTC hour.

    Copies of a frame are equal in all columns used here, so a plain distinct (hashed, combined
    before the shuffle) keeps one of each. With ``by`` the rows are partitioned by those columns
    first: the distinct and an aggregation by them then need no other shuffle. That is for keys
    of which none holds a large share, such as source and hour.
    """
    rows = deliveries(spark, d, *columns)
    return (rows.repartition(*by) if by else rows).distinct()


BY_WINDOW = ("source_mac", "window_start")

FRAMES_SQL = f"f AS (SELECT DISTINCT {canon_sql('source_mac')} AS source_mac, {', '.join(COLUMNS)} FROM projection_frames)"
TOKEN_SQL = (
    "CASE " + " ".join(f"WHEN {{s}} = '{t}' THEN '{t}'" for t in MANAGEMENT) + " " + " ".join(f"WHEN {{s}} = '{a}' THEN '{t}'" for a, t in SPELLINGS.items()) + " WHEN lower(trim(frame_type)) = 'data' THEN 'data' ELSE 'other' END"
).replace("{s}", "translate(lower(trim(frame_subtype)), '- ', '__')")
HOUR = "date_trunc('hour', observed_at)"


def hour_us(c: str = "window_start") -> Column:
    return epoch_us(F.col(c)).alias("window_us")


def last_known(c: str) -> Column:
    """The value of the last row, by (observed_at, dedupe_key), that has one."""
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("observed_at", "dedupe_key"))).alias(c)


LAST_SQL = "arg_max({c}, (observed_at, dedupe_key)) FILTER (WHERE {c} IS NOT NULL) AS {c}"


@query("q01_window_source_count", f"WITH {FRAMES_SQL} SELECT source_mac, epoch_us({HOUR}) AS window_us, count(*) AS n FROM f GROUP BY ALL")
def window_source_count(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d, by=BY_WINDOW).groupBy("source_mac", "window_start").agg(F.count("*").alias("n")).select("source_mac", hour_us(), "n")


def behavior(rows: DataFrame) -> DataFrame:
    """One row per source and UTC hour, without the two count maps."""
    g = rows.groupBy("source_mac", "window_start").agg(
        last_known("location_id"), last_known("sensor_id"), F.count("*").alias("event_count"), F.min("signal_dbm").cast("double").alias("min_signal"), F.max("signal_dbm").cast("double").alias("max_signal"),
        F.avg("signal_dbm").alias("avg_signal"), F.count_if("retry").alias("retry_count"), F.count_if("protected").alias("protected_count"), F.count_if(~F.col("protected")).alias("unprotected_count"),
        F.count_distinct("bssid").alias("distinct_bssids"), F.array_join(F.array_sort(F.collect_set("adjacent_mac_hint")), ",").alias("adjacent_macs"),
    )
    key = F.concat_ws(":", "source_mac", F.unix_seconds("window_start"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    end = F.col("window_start") + F.expr("INTERVAL 1 HOUR")
    text = F.concat(F.col("event_count"), F.lit(" wireless frames for "), F.col("source_mac"), F.lit(" from "), iso(F.col("window_start")), F.lit(" to "), iso(end))
    return g.select(
        stable_id("behavior", key).alias("snapshot_id"), key.alias("snapshot_key"), "source_mac", "location_id", "sensor_id", hour_us(), "event_count", text.alias("text_summary"), "min_signal", "max_signal",
        "avg_signal", "retry_count", "protected_count", "unprotected_count", "distinct_bssids", "adjacent_macs", (F.col("adjacent_macs") != "").alias("rotation_suspected"), stable_id("behavior-run", key).alias("run_id"),
    )


def stable_sql(namespace: str, *parts: str) -> str:
    h = f"sha256(concat_ws(chr(31), '{namespace}', {', '.join(parts)}))"
    return f"substr({h},1,8)||'-'||substr({h},9,4)||'-5'||substr({h},14,3)||'-a'||substr({h},18,3)||'-'||substr({h},21,12)"


_KEY = "source_mac || ':' || CAST(epoch_us(w) // 1000000 AS VARCHAR)"
_BEHAVIOR = f"""
WITH {FRAMES_SQL}, g AS (
 SELECT source_mac, {HOUR} AS w, {LAST_SQL.format(c='location_id')}, {LAST_SQL.format(c='sensor_id')}, count(*) AS event_count, CAST(min(signal_dbm) AS DOUBLE) AS min_signal, CAST(max(signal_dbm) AS DOUBLE) AS max_signal,
  avg(signal_dbm) AS avg_signal, count(*) FILTER (WHERE retry) AS retry_count, count(*) FILTER (WHERE protected) AS protected_count, count(*) FILTER (WHERE NOT protected) AS unprotected_count,
  count(DISTINCT bssid) AS distinct_bssids, coalesce(string_agg(DISTINCT adjacent_mac_hint, ',' ORDER BY adjacent_mac_hint), '') AS adjacent_macs
 FROM f GROUP BY 1, 2)
SELECT {stable_sql('behavior', _KEY)} AS snapshot_id, {_KEY} AS snapshot_key, source_mac, location_id, sensor_id, epoch_us(w) AS window_us, event_count,
 event_count || ' wireless frames for ' || source_mac || ' from ' || strftime(w, '%Y-%m-%dT%H:%M:%SZ') || ' to ' || strftime(w + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS text_summary,
 min_signal, max_signal, avg_signal, retry_count, protected_count, unprotected_count, distinct_bssids, adjacent_macs, adjacent_macs <> '' AS rotation_suspected, {stable_sql('behavior-run', _KEY)} AS run_id FROM g"""


@query("q02_behavior_snapshot", _BEHAVIOR)
def behavior_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return behavior(frames(spark, d, *COLUMNS, by=BY_WINDOW))


@query("q02b_behavior_frame_mix", f"WITH {FRAMES_SQL} SELECT source_mac, epoch_us({HOUR}) AS window_us, {TOKEN_SQL} AS token, count(*) AS n FROM f GROUP BY ALL")
def behavior_frame_mix(spark: SparkSession, d: str) -> DataFrame:
    token = frame_token(F.col("frame_type"), F.col("frame_subtype")).alias("token")
    return frames(spark, d, "frame_type", "frame_subtype").groupBy("source_mac", "window_start", token).agg(F.count("*").alias("n")).select("source_mac", hour_us(), "token", "n")


@query("q02c_behavior_protocol_mix", f"""
WITH {FRAMES_SQL}, n AS (SELECT source_mac, epoch_us({HOUR}) AS window_us, lower(app_protocol) AS p, count(*) AS n FROM f WHERE app_protocol <> '' GROUP BY ALL)
SELECT source_mac, window_us, string_agg(p || '=' || n, ',' ORDER BY p) AS protocol_mix FROM n GROUP BY ALL""")
def behavior_protocol_mix(spark: SparkSession, d: str) -> DataFrame:
    """Counts by protocol as one text per window; empty names do not count."""
    n = frames(spark, d, "app_protocol").where("app_protocol <> ''").groupBy("source_mac", "window_start", F.lower("app_protocol").alias("p")).agg(F.count("*").alias("n"))
    mix = F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "p", "n"))), ",").alias("protocol_mix")
    return n.groupBy("source_mac", "window_start").agg(mix).select("source_mac", hour_us(), "protocol_mix")


def timing(rows: DataFrame) -> DataFrame:
    """Exact percentiles and median absolute deviations by source and UTC hour."""
    keys = ["source_mac", "window_start"]
    first = rows.groupBy(*keys).agg(
        last_known("sensor_id"), last_known("location_id"), F.percentile("tsft_delta_us", F.lit(0.5)).alias("tsft_p50"), F.percentile("tsft_delta_us", F.lit(0.95)).alias("tsft_p95"),
        F.percentile("wall_clock_delta_ms", F.lit(0.5)).alias("wall_p50"), F.count("*").alias("source_event_count"),
    )
    again = rows.join(first.select(*keys, "tsft_p50", "wall_p50"), keys).groupBy(*keys).agg(
        F.percentile(F.abs(F.col("tsft_delta_us") - F.col("tsft_p50")), F.lit(0.5)).alias("tsft_jitter"),
        F.percentile(F.abs(F.col("wall_clock_delta_ms") - F.col("wall_p50")), F.lit(0.5)).alias("wall_jitter"),
    )
    return first.join(again, keys)


_TIMING = f"""
WITH {FRAMES_SQL}, g AS (
 SELECT source_mac, {HOUR} AS w, {LAST_SQL.format(c='sensor_id')}, {LAST_SQL.format(c='location_id')}, quantile_cont(CAST(tsft_delta_us AS DOUBLE), 0.5) AS tsft_p50, quantile_cont(CAST(tsft_delta_us AS DOUBLE), 0.95) AS tsft_p95,
  mad(CAST(tsft_delta_us AS DOUBLE)) AS tsft_jitter, quantile_cont(CAST(wall_clock_delta_ms AS DOUBLE), 0.5) AS wall_p50, mad(CAST(wall_clock_delta_ms AS DOUBLE)) AS wall_jitter, count(*) AS source_event_count
 FROM f GROUP BY 1, 2)
SELECT {_KEY} AS profile_key, sensor_id, location_id, tsft_p50, tsft_p95, tsft_jitter, wall_p50, wall_jitter, source_event_count, {stable_sql('timing-run', _KEY)} AS run_id FROM g"""


@query("q03_timing_profile", _TIMING)
def timing_profile(spark: SparkSession, d: str) -> DataFrame:
    key = F.concat_ws(":", "source_mac", F.unix_seconds("window_start"))
    return timing(frames(spark, d, "sensor_id", "location_id", "tsft_delta_us", "wall_clock_delta_ms", by=BY_WINDOW)).select(
        key.alias("profile_key"), "sensor_id", "location_id", "tsft_p50", "tsft_p95", "tsft_jitter", "wall_p50", "wall_jitter", "source_event_count", stable_id("timing-run", key).alias("run_id")
    )


def sessions(rows: DataFrame) -> DataFrame:
    """The ordered tokens of each session_key."""
    token = frame_token(F.col("frame_type"), F.col("frame_subtype"))
    order = F.struct("observed_at", "dedupe_key")
    return rows.where("session_key is not null").withColumn("token", token).groupBy("session_key").agg(
        F.min_by("source_mac", order).alias("source_mac"), last_known("location_id"), last_known("sensor_id"), F.min("observed_at").alias("window_start"), F.max("observed_at").alias("window_end"),
        F.transform(F.array_sort(F.collect_list(F.struct("observed_at", "dedupe_key", "token"))), lambda x: x["token"]).alias("tokens"),
    )


@query("q04_session_sequence", f"""
WITH {FRAMES_SQL} SELECT session_key, arg_min(source_mac, (observed_at, dedupe_key)) AS source_mac, {LAST_SQL.format(c='location_id')}, {LAST_SQL.format(c='sensor_id')},
 epoch_us(min(observed_at)) AS start_us, epoch_us(max(observed_at)) AS end_us, string_agg({TOKEN_SQL}, ' ' ORDER BY observed_at, dedupe_key) AS sequence_tokens, count(*) AS frame_count
FROM f WHERE session_key IS NOT NULL GROUP BY session_key""")
def session_sequence(spark: SparkSession, d: str) -> DataFrame:
    s = sessions(frames(spark, d, "session_key", "location_id", "sensor_id", "frame_type", "frame_subtype").drop("window_start"))
    return s.select("session_key", "source_mac", "location_id", "sensor_id", epoch_us(F.col("window_start")).alias("start_us"), epoch_us(F.col("window_end")).alias("end_us"), F.array_join("tokens", " ").alias("sequence_tokens"), F.size("tokens").cast("long").alias("frame_count"))


def transitions(rows: DataFrame) -> DataFrame:
    """Counts and probabilities of token pairs over all sessions, with the vocabulary size."""
    token = frame_token(F.col("frame_type"), F.col("frame_subtype"))
    pairs = neighbour_counts(rows.select(F.col("session_key").alias("key"), epoch_us(F.col("observed_at")).alias("ts_us"), F.col("dedupe_key").alias("tie"), token.alias("value")))
    counts = pairs.select(F.col("previous").alias("previous_token"), F.col("next").alias("next_token"), F.col("n").alias("transition_count"))
    total = F.sum("transition_count").over(Window.partitionBy("previous_token"))
    return counts.withColumn("previous_total", total).withColumn("probability", F.col("transition_count") / F.nullif("previous_total", F.lit(0))).withColumn("vocabulary", F.lit(len(TOKENS)))


@query("q05_transition_probabilities", f"""
WITH {FRAMES_SQL}, t AS (SELECT session_key, {TOKEN_SQL} AS p, lead({TOKEN_SQL}) OVER (PARTITION BY session_key ORDER BY observed_at, dedupe_key) AS n FROM f WHERE session_key IS NOT NULL),
c AS (SELECT p, n, count(*) AS k FROM t WHERE n IS NOT NULL GROUP BY ALL)
SELECT p AS previous_token, n AS next_token, k AS transition_count, CAST(sum(k) OVER (PARTITION BY p) AS BIGINT) AS previous_total, CAST(k AS DOUBLE) / sum(k) OVER (PARTITION BY p) AS probability, 13 AS vocabulary FROM c""")
def transition_probabilities(spark: SparkSession, d: str) -> DataFrame:
    return transitions(frames(spark, d, "session_key", "frame_type", "frame_subtype"))


@query("q05b_session_transitions", """
WITH s AS (SELECT DISTINCT session_key, tokens FROM frame_sequences WHERE tokens IS NOT NULL),
t AS (SELECT session_key, unnest(tokens) AS p, unnest(generate_series(1, len(tokens))) AS i, tokens FROM s)
SELECT session_key, p AS previous_token, tokens[i + 1] AS next_token, count(*) AS n FROM t WHERE i < len(tokens) GROUP BY ALL""")
def session_transitions(spark: SparkSession, d: str) -> DataFrame:
    """Contributions of each stored session: adjacent pairs by zipping the array with itself."""
    s = table(spark, d, "frame_sequences").select("session_key", "tokens").where("size(tokens) > 1").distinct()
    pairs = F.arrays_zip(F.slice("tokens", F.lit(1), F.size("tokens") - 1).alias("p"), F.slice("tokens", F.lit(2), F.size("tokens") - 1).alias("n"))
    return s.select("session_key", F.explode(pairs).alias("x")).groupBy("session_key", F.col("x.p").alias("previous_token"), F.col("x.n").alias("next_token")).agg(F.count("*").alias("n"))


@query("q06_baseline_percentiles", f"""
WITH {FRAMES_SQL} SELECT {stable_sql('baseline', 'bssid', "'signal_dbm'")} AS baseline_id, bssid, quantile_cont(CAST(signal_dbm AS DOUBLE), 0.05) AS p5, quantile_cont(CAST(signal_dbm AS DOUBLE), 0.5) AS p50,
 quantile_cont(CAST(signal_dbm AS DOUBLE), 0.95) AS p95, count(*) AS n FROM f WHERE bssid IS NOT NULL AND signal_dbm IS NOT NULL GROUP BY bssid""")
def baseline_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact: signals are small integers, so a group's state is a short table of counts."""
    g = frames(spark, d, "bssid", "signal_dbm").where("bssid is not null and signal_dbm is not null").groupBy("bssid")
    p = g.agg(F.percentile("signal_dbm", F.array(*map(F.lit, (0.05, 0.5, 0.95)))).alias("p"), F.count("*").alias("n"))
    return p.select(stable_id("baseline", F.col("bssid"), F.lit("signal_dbm")).alias("baseline_id"), "bssid", F.col("p")[0].alias("p5"), F.col("p")[1].alias("p50"), F.col("p")[2].alias("p95"), "n")


@query("q07b_stale_sessions", f"""
WITH {FRAMES_SQL}, c AS (SELECT session_key, count(*) AS n FROM f WHERE session_key IS NOT NULL GROUP BY 1), s AS (SELECT session_key, max(coalesce(len(tokens), 0)) AS m FROM frame_sequences GROUP BY 1)
SELECT c.session_key, n AS source_count, m AS stored_count FROM c LEFT JOIN s USING (session_key) WHERE m IS NULL OR m <> n""")
def stale_sessions(spark: SparkSession, d: str) -> DataFrame:
    now = frames(spark, d, "session_key").where("session_key is not null").groupBy("session_key").agg(F.count("*").alias("source_count"))
    stored = table(spark, d, "frame_sequences").groupBy("session_key").agg(F.max(F.coalesce(F.array_size("tokens"), F.lit(0))).cast("long").alias("stored_count"))
    return now.join(stored, "session_key", "left").where("stored_count is null or stored_count <> source_count")


@query("q07c_stale_baselines", f"""
WITH {FRAMES_SQL}, c AS (SELECT bssid, count(*) AS n FROM f WHERE bssid IS NOT NULL AND signal_dbm IS NOT NULL GROUP BY 1),
s AS (SELECT bssid, 'signal_dbm' AS metric, count(*) AS m FROM f WHERE bssid IS NOT NULL AND signal_dbm IS NOT NULL AND observed_at < TIMESTAMP '2021-01-24' GROUP BY 1)
SELECT c.bssid, n AS source_count, m AS stored_count FROM c LEFT JOIN s ON s.bssid = c.bssid AND s.metric = 'signal_dbm' WHERE m IS NULL OR m <> n""")
def stale_baselines(spark: SparkSession, d: str) -> DataFrame:
    """Baselines that readings of the last day made stale; the constant of the join is filtered first."""
    rows = frames(spark, d, "bssid", "signal_dbm").where("bssid is not null and signal_dbm is not null")
    now = rows.groupBy("bssid").agg(F.count("*").alias("source_count"))
    stored = rows.where("observed_at < timestamp_ntz'2021-01-24'").groupBy("bssid").agg(F.count("*").alias("stored_count")).withColumn("metric", F.lit("signal_dbm"))
    return now.join(stored.where("metric = 'signal_dbm'").drop("metric"), "bssid", "left").where("stored_count is null or stored_count <> source_count")


_CHANNEL = "1 + abs(signal_dbm) * 3"


@query("q46_case_band", f"WITH {FRAMES_SQL} SELECT dedupe_key, CASE WHEN {_CHANNEL} BETWEEN 1 AND 14 THEN '2.4GHz' WHEN {_CHANNEL} > 14 AND {_CHANNEL} <= 233 THEN '5GHz' ELSE 'unknown' END AS band FROM f WHERE signal_dbm IS NOT NULL")
def case_band(spark: SparkSession, d: str) -> DataFrame:
    """The band of a channel number made of the signal of each frame."""
    return frames(spark, d, *COLUMNS).where("signal_dbm is not null").select("dedupe_key", band(1 + F.abs("signal_dbm") * 3).alias("band"))
