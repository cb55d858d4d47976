"""Ledger semantics: dedupe, tombstones, cursors, planning, states, retention, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.mac import epoch_us
from skysift.functions.ids import sha256
from skysift.operators.match import null_tolerant_anti, single_match
from skysift.plans.registry import NOW, Registry
from skysift.sources.tables import table

query = Registry()
TS = f"timestamp_ntz'{NOW}'"
DONE = ("completed", "failed", "cancelled", "done")


@query("q39_dedupe_first", """
WITH r AS (SELECT delivery_id, stream_name, dedupe_key, row_number() OVER (PARTITION BY stream_name, dedupe_key ORDER BY received_at, delivery_id) AS k FROM broker_records)
SELECT delivery_id, CASE WHEN k = 1 THEN 'processed' ELSE 'duplicate' END AS disposition FROM r""")
def dedupe_first(spark: SparkSession, d: str) -> DataFrame:
    """Disposition of every delivery: the first of a message is processed.

    The first is found by an aggregate that combines before the shuffle, and joined back, so
    that a message with very many deliveries is not sorted in one task.
    """
    rows = table(spark, d, "broker_records").select("delivery_id", "stream_name", "dedupe_key", "received_at")
    first = rows.groupBy("stream_name", "dedupe_key").agg(F.min(F.struct("received_at", "delivery_id")).alias("first")).select(F.col("first.delivery_id").alias("delivery_id"), F.lit("processed").alias("disposition"))
    return rows.select("delivery_id").join(first, "delivery_id", "left").select("delivery_id", F.coalesce("disposition", F.lit("duplicate")).alias("disposition"))


@query("q39b_replay_evidence", """
SELECT consumer_group, topic, partition_id, record_offset, count(*) AS deliveries, count(DISTINCT payload_sha256) > 1 OR count(DISTINCT dedupe_key) > 1 AS changed
FROM broker_records GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""")
def replay_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Positions delivered again, and whether the record there changed (an error)."""
    g = table(spark, d, "broker_records").groupBy("consumer_group", "topic", "partition_id", "record_offset")
    differs = lambda c: F.min(c) != F.max(c)
    return g.agg(F.count("*").alias("deliveries"), (differs("payload_sha256") | differs("dedupe_key")).alias("changed")).where("deliveries > 1")


@query("q39c_next_offsets", """
SELECT consumer_group, topic, partition_id, max(record_offset) + 1 AS next_offset, arg_max(payload_sha256, (record_offset, received_at, delivery_id)) AS payload_sha256, arg_max(group_version, (record_offset, received_at, delivery_id)) AS group_version
FROM broker_records GROUP BY 1, 2, 3""")
def next_offsets(spark: SparkSession, d: str) -> DataFrame:
    """The greatest next offset of a partition, with the digest and version of its record."""
    order = F.struct("record_offset", "received_at", "delivery_id")
    g = table(spark, d, "broker_records").groupBy("consumer_group", "topic", "partition_id")
    return g.agg((F.max("record_offset") + 1).alias("next_offset"), F.max_by("payload_sha256", order).alias("payload_sha256"), F.max_by("group_version", order).alias("group_version"))


def tombstones(spark: SparkSession, d: str) -> DataFrame:
    """Stand-in for the tombstone table: archived messages, kept for 15 days after they were seen."""
    return table(spark, d, "sync_events").where("payload is null").groupBy("stream_name", "dedupe_key").agg((F.max("observed_at") + F.expr("INTERVAL 15 DAYS")).alias("expires_at"))


@query("q40_tombstone_filter", f"""
WITH t AS (SELECT stream_name, dedupe_key, max(observed_at) + INTERVAL 15 DAY AS expires_at FROM sync_events WHERE payload IS NULL GROUP BY 1, 2)
SELECT delivery_id FROM broker_records b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.stream_name = b.stream_name AND t.dedupe_key = b.dedupe_key AND t.expires_at > TIMESTAMP '{NOW}')""")
def tombstone_filter(spark: SparkSession, d: str) -> DataFrame:
    live = tombstones(spark, d).where(f"expires_at > {TS}")
    return table(spark, d, "broker_records").join(live, ["stream_name", "dedupe_key"], "left_anti").select("delivery_id")


def cursor_end(stream: Column, observed: Column, key: Column) -> Column:
    """Epoch seconds for audit messages, else the message key."""
    return F.when(stream == "wireless.audit", F.unix_seconds(observed.cast("timestamp")).cast("string")).otherwise(key)


def cursor_order(c: Column) -> Column:
    """Orders digit texts of any length by value, and all others by text."""
    digits = F.ltrim(c, F.lit("0"))
    numeric = c.rlike(r"^[0-9]+\z")
    return F.struct(F.when(numeric, F.length(digits)).otherwise(0).alias("size"), F.when(numeric, digits).otherwise(c).alias("text"))


@query("q41_cursor_max", """
WITH c AS (SELECT stream_name, CASE WHEN stream_name = 'wireless.audit' THEN CAST(epoch_us(observed_at) // 1000000 AS VARCHAR) ELSE dedupe_key END AS v FROM sync_events)
SELECT stream_name, CASE WHEN bool_and(regexp_full_match(v, '[0-9]+')) THEN CAST(max(TRY_CAST(v AS HUGEINT)) AS VARCHAR) ELSE max(v) END AS cursor_value, bool_or(regexp_full_match(v, '[0-9]+')) <> bool_and(regexp_full_match(v, '[0-9]+')) AS mixed FROM c GROUP BY 1""")
def cursor_max(spark: SparkSession, d: str) -> DataFrame:
    """The furthest cursor of a stream; a stream that mixes both formats is an error (mixed)."""
    c = table(spark, d, "sync_events").select("stream_name", cursor_end(F.col("stream_name"), F.col("observed_at"), F.col("dedupe_key")).alias("v"))
    numeric = F.col("v").rlike(r"^[0-9]+\z")
    return c.groupBy("stream_name").agg(F.max_by("v", cursor_order(F.col("v"))).alias("cursor_value"), (F.bool_or(numeric) != F.bool_and(numeric)).alias("mixed"))


def planned(events: DataFrame, cursors: DataFrame) -> DataFrame:
    """Jobs and batches of due messages: pending or failed ones, with their cursor range."""
    due = events.where(F.col("status").isin("pending", "failed"))
    return due.join(cursors, "stream_name", "left").select(
        "stream_name", "dedupe_key", F.lit(0).alias("batch_no"), "payload_ref", F.coalesce("cursor_value", F.lit("0")).alias("cursor_start"),
        cursor_end(F.col("stream_name"), F.col("observed_at"), F.col("dedupe_key")).alias("cursor_end"), F.lit("batched").alias("status_after"), (F.col("attempt_count") + 1).alias("attempt_after"),
    )


@query("q48_job_planner", """
WITH e AS (SELECT stream_name, dedupe_key, min(status) AS status, min(observed_at) AS observed_at, min(payload_ref) AS payload_ref, min(attempt_count) AS attempt_count FROM sync_events GROUP BY 1, 2),
c AS (SELECT stream_name, CAST(max(epoch_us(observed_at) // 1000000) AS VARCHAR) AS cursor_value FROM e WHERE stream_name = 'wireless.audit' AND status = 'done' GROUP BY 1)
SELECT stream_name, dedupe_key, 0 AS batch_no, payload_ref, coalesce(cursor_value, '0') AS cursor_start, CASE WHEN stream_name = 'wireless.audit' THEN CAST(epoch_us(observed_at) // 1000000 AS VARCHAR) ELSE dedupe_key END AS cursor_end,
 'batched' AS status_after, attempt_count + 1 AS attempt_after FROM e LEFT JOIN c USING (stream_name) WHERE status IN ('pending', 'failed')""")
def job_planner(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "sync_events").groupBy("stream_name", "dedupe_key").agg(*(F.min(c).alias(c) for c in ("status", "observed_at", "payload_ref", "attempt_count")))
    cursors = e.where("stream_name = 'wireless.audit' and status = 'done'").groupBy("stream_name").agg(F.max(F.unix_seconds(F.col("observed_at").cast("timestamp"))).cast("string").alias("cursor_value"))
    return planned(e, cursors)


def transition(status: Column, outcome: Column, error: Column, attempts: Column, most: int) -> Column:
    """Next state of a batch after a result: completed, pending again, or failed."""
    open_ = status.isin("pending", "dispatched", "running", "batched")
    after = F.when(outcome == "success", "completed").when((error == "retryable") & (attempts < most), "pending").otherwise("failed")
    return F.when(open_, after).when((status == "completed") & (outcome == "success"), status)


def decoded_results(results: DataFrame) -> DataFrame:
    """Batch results ``(.., value)`` as job_id, batch_id, status, error_class, retryable, and what is wrong with them.

    retryable follows from error_class; one that says otherwise is refused.
    """
    v = F.try_parse_json("value")
    s = lambda c: F.try_variant_get("v", f"$.{c}", "string")
    r = results.withColumn("v", v).withColumn("error_class", F.coalesce(s("error_class"), F.lit("")))
    said = F.try_variant_get("v", "$.retryable", "boolean")
    wrong = F.when(F.col("v").isNull(), "not JSON").when(s("job_id").isNull() | s("batch_id").isNull() | s("status").isNull(), "a member is missing").when(said != (F.col("error_class") == "retryable"), "retryable conflicts with error_class")
    return r.select(*results.columns, s("job_id").alias("job_id"), s("batch_id").alias("batch_id"), s("status").alias("outcome"), "error_class", wrong.alias("error"))


def made_results(events: DataFrame) -> DataFrame:
    """Results made of the ledger: two digits of the digest say how a batch ended and why."""
    e = events.select("stream_name", "dedupe_key", "status", "attempt_count", F.substring("payload_sha256", 1, 1).alias("x"), F.substring("payload_sha256", 2, 1).alias("y")).distinct()
    kind = F.when(F.col("y") < "8", "retryable").otherwise("permanent")
    body = F.struct(F.col("stream_name").alias("job_id"), F.col("dedupe_key").alias("batch_id"), F.when(F.col("x") < "8", "success").otherwise("failed").alias("status"), kind.alias("error_class"), F.when(F.col("x") != "3", kind == "retryable").otherwise(kind != "retryable").alias("retryable"))
    return e.withColumn("value", F.to_json(body))


@query("q48b_result_transition", """
SELECT stream_name AS job_id, dedupe_key AS batch_id, status, attempt_count, CASE WHEN x = '3' THEN 'retryable conflicts with error_class' END AS error, CASE WHEN x = '3' THEN NULL WHEN status IN ('pending', 'batched') THEN CASE WHEN x < '8' THEN 'completed' WHEN y < '8' AND attempt_count < 3 THEN 'pending' ELSE 'failed' END WHEN status = 'done' AND x < '8' THEN 'completed' END AS next_status
FROM (SELECT DISTINCT stream_name, dedupe_key, status, attempt_count, substr(payload_sha256, 1, 1) AS x, substr(payload_sha256, 2, 1) AS y FROM sync_events)""")
def result_transition(spark: SparkSession, d: str) -> DataFrame:
    """The next state of each batch after its result; refused results change nothing."""
    return moved(made_results(table(spark, d, "sync_events")))


def moved(results: DataFrame) -> DataFrame:
    """Batches ``(status, attempt_count, value)`` after their results."""
    r = decoded_results(results)
    state = F.when(F.col("status") == "done", "completed").otherwise(F.col("status"))
    after = F.when(F.col("error").isNull(), transition(state, F.col("outcome"), F.col("error_class"), F.col("attempt_count"), 3))
    return r.select("job_id", "batch_id", "status", "attempt_count", "error", after.alias("next_status"))


@query("q48c_stale_cleanup", f"""
SELECT DISTINCT stream_name, dedupe_key, updated_at, CASE WHEN attempt_count >= 2 THEN 'failed' ELSE 'pending' END AS status_after, CASE WHEN attempt_count >= 2 THEN 'worker lease expired; retries exhausted' ELSE 'worker lease expired; returned to pending' END AS error_after
FROM sync_events WHERE status = 'batched' AND updated_at + INTERVAL 1 DAY <= TIMESTAMP '{NOW}'""")
def stale_cleanup(spark: SparkSession, d: str) -> DataFrame:
    """Work whose lease (a day after the last update) has run out."""
    stale = table(spark, d, "sync_events").where(f"status = 'batched' and updated_at <= {TS} - INTERVAL 1 DAY")
    spent = F.col("attempt_count") >= 2
    return stale.select(
        "stream_name", "dedupe_key", "updated_at", F.when(spent, "failed").otherwise("pending").alias("status_after"),
        F.when(spent, "worker lease expired; retries exhausted").otherwise("worker lease expired; returned to pending").alias("error_after"),
    ).distinct()


@query("q36_oldest_pending", """
SELECT stream_name, dedupe_key, epoch_us(created_at) AS created_us FROM (SELECT DISTINCT stream_name, dedupe_key, created_at FROM sync_events WHERE status IN ('pending', 'failed')) ORDER BY created_at, stream_name, dedupe_key LIMIT 100""")
def oldest_pending(spark: SparkSession, d: str) -> DataFrame:
    """The 100 oldest due messages (the limit is the feature: a backlog listing)."""
    due = table(spark, d, "sync_events").where("status in ('pending', 'failed')").select("stream_name", "dedupe_key", "created_at").distinct()
    return due.orderBy("created_at", "stream_name", "dedupe_key").limit(100).select("stream_name", "dedupe_key", epoch_us(F.col("created_at")).alias("created_us"))


@query("q37_keyset_page", """
SELECT stream_name, dedupe_key, epoch_us(observed_at) AS observed_us FROM (SELECT DISTINCT stream_name, dedupe_key, observed_at FROM sync_events)
WHERE (observed_at, stream_name, dedupe_key) > (TIMESTAMP '2021-01-14 12:00:00', 'wireless.audit', 'm') ORDER BY observed_at, stream_name, dedupe_key LIMIT 500""")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    """One page of 500 after a cursor; the leading column is also compared bare, so it is pushed down."""
    at = "timestamp_ntz'2021-01-14 12:00:00'"
    rows = table(spark, d, "sync_events").select("stream_name", "dedupe_key", "observed_at").where(f"observed_at >= {at}").distinct()
    later = rows.where(F.struct("observed_at", "stream_name", "dedupe_key") > F.struct(F.expr(at).alias("observed_at"), F.lit("wireless.audit").alias("stream_name"), F.lit("m").alias("dedupe_key")))
    return later.orderBy("observed_at", "stream_name", "dedupe_key").limit(500).select("stream_name", "dedupe_key", epoch_us(F.col("observed_at")).alias("observed_us"))


@query("q38_newest_n", "SELECT dedupe_key, epoch_us(max(observed_at)) AS last_us FROM projection_frames GROUP BY 1 ORDER BY max(observed_at) DESC, dedupe_key LIMIT 250")
def newest_n(spark: SparkSession, d: str) -> DataFrame:
    """The 250 newest frames (the limit is the feature)."""
    newest = table(spark, d, "projection_frames").groupBy("dedupe_key").agg(F.max("observed_at").alias("last"))
    return newest.orderBy(F.desc("last"), "dedupe_key").limit(250).select("dedupe_key", epoch_us(F.col("last")).alias("last_us"))


@query("q15_retention_eligible", f"""
SELECT DISTINCT stream_name, dedupe_key, payload_sha256 FROM sync_events e WHERE payload IS NULL AND payload_sha256 IS NOT NULL AND observed_at < TIMESTAMP '{NOW}' - INTERVAL 3 DAY
 AND EXISTS (SELECT 1 FROM broker_records b WHERE b.stream_name = e.stream_name AND b.dedupe_key = e.dedupe_key AND b.payload_sha256 = e.payload_sha256)
 AND NOT EXISTS (SELECT 1 FROM sync_events j WHERE j.stream_name = e.stream_name AND j.dedupe_key = e.dedupe_key AND j.status IN ('pending', 'failed'))
 AND NOT EXISTS (SELECT 1 FROM broker_records b JOIN sync_events o ON o.payload_sha256 = b.payload_sha256 WHERE b.stream_name = e.stream_name AND b.dedupe_key = e.dedupe_key AND o.status = 'pending')""")
def retention_eligible(spark: SparkSession, d: str) -> DataFrame:
    """Archived messages past retention with an archive row and no open work.

    Deliveries stand in for archive and batch rows, ledger rows for jobs and outbox.
    """
    e, b = table(spark, d, "sync_events"), table(spark, d, "broker_records")
    keys = ["stream_name", "dedupe_key"]
    old = e.where(f"payload is null and payload_sha256 is not null and observed_at < {TS} - INTERVAL 3 DAYS").select(*keys, "payload_sha256").distinct()
    archived = old.join(b.select(*keys, "payload_sha256"), [*keys, "payload_sha256"], "left_semi")
    open_jobs = e.where("status in ('pending', 'failed')").select(*keys)
    outbox = b.join(e.where("status = 'pending'").select("payload_sha256"), "payload_sha256", "left_semi").select(*keys)
    return archived.join(open_jobs, keys, "left_anti").join(outbox, keys, "left_anti")


@query("q15b_search_retention", f"""
SELECT doc_id FROM documents x WHERE observed_at < TIMESTAMP '{NOW}' - INTERVAL 10 DAY AND NOT EXISTS (SELECT 1 FROM sync_events j WHERE json_extract_string(CASE WHEN json_valid(j.payload) THEN j.payload END, '$.sensor_id') = x.sensor_id AND j.status = 'pending')""")
def search_retention(spark: SparkSession, d: str) -> DataFrame:
    """Old documents for whose sensor no work is open."""
    open_ = table(spark, d, "sync_events").where("status = 'pending'").select(F.try_variant_get(F.try_parse_json("payload"), "$.sensor_id", "string").alias("sensor_id")).where("sensor_id is not null")
    return table(spark, d, "documents").where(f"observed_at < {TS} - INTERVAL 10 DAYS").join(open_, "sensor_id", "left_anti").select("doc_id")


_CHILDREN = {"radio": "signal_dbm is not null", "network": "app_protocol is not null", "identity": "session_key is not null", "security": "protected", "qos": "retry", "app_signals": "tsft_delta_us is not null"}
_FLAGS = ", ".join(f"count(*) FILTER (WHERE {cond}) = 0 AS no_{name}" for name, cond in _CHILDREN.items())


@query("q13_missing_children", f"""
WITH m AS (SELECT dedupe_key, {_FLAGS} FROM projection_frames GROUP BY 1) SELECT * FROM m WHERE {' OR '.join(f'no_{n}' for n in _CHILDREN)}""")
def missing_children(spark: SparkSession, d: str) -> DataFrame:
    """Frames that lack a row in one of six child tables (here: parts of the frame table), by one aggregate."""
    return _child_flags(spark, d).where(" or ".join(f"no_{n}" for n in _CHILDREN))


def _child_flags(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "projection_frames").groupBy("dedupe_key")
    return rows.agg(*(F.coalesce(~F.bool_or(F.expr(cond)), F.lit(True)).alias(f"no_{n}") for n, cond in _CHILDREN.items()))


@query("q14_resolved_findings", "SELECT DISTINCT dedupe_key FROM projection_frames f WHERE " + " AND ".join(f"EXISTS (SELECT 1 FROM projection_frames c WHERE c.dedupe_key = f.dedupe_key AND {cond})" for cond in _CHILDREN.values()))
def resolved_findings(spark: SparkSession, d: str) -> DataFrame:
    """Frames that have a row in all child tables: their findings are resolved."""
    return _child_flags(spark, d).where(" and ".join(f"not no_{n}" for n in _CHILDREN)).select("dedupe_key")


@query("q09b_unprojected_rows", """
SELECT DISTINCT e.dedupe_key FROM sync_events e WHERE e.stream_name = 'wireless.audit' AND e.payload IS NOT NULL AND NOT EXISTS (SELECT 1 FROM projection_frames f WHERE f.dedupe_key = e.dedupe_key AND f.sensor_id IS NOT NULL)""")
def unprojected_rows(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "projection_frames").where("sensor_id is not null").select("dedupe_key")
    return table(spark, d, "sync_events").where("stream_name = 'wireless.audit' and payload is not null").select("dedupe_key").distinct().join(done, "dedupe_key", "left_anti")


@query("q09c_unprojected_children", f"""
WITH e AS (SELECT DISTINCT dedupe_key FROM sync_events WHERE stream_name = 'wireless.audit' AND payload IS NOT NULL), x AS (SELECT dedupe_key, {', '.join(f"count(*) FILTER (WHERE {cond}) > 0 AS has_{n}" for n, cond in _CHILDREN.items())} FROM projection_frames GROUP BY 1)
SELECT child, count(*) AS missing FROM ({' UNION ALL '.join(f"SELECT '{n}' AS child FROM e LEFT JOIN x USING (dedupe_key) WHERE NOT coalesce(has_{n}, false)" for n in _CHILDREN)} UNION ALL SELECT 'frames' FROM e LEFT JOIN x USING (dedupe_key) WHERE x.has_radio IS NULL) GROUP BY 1""")
def unprojected_children(spark: SparkSession, d: str) -> DataFrame:
    """How many audit messages lack a row in each of the seven frame tables: one join, then the gaps as rows."""
    e = table(spark, d, "sync_events").where("stream_name = 'wireless.audit' and payload is not null").select("dedupe_key").distinct()
    joined = e.join(_child_flags(spark, d).withColumn("no_frames", F.lit(False)), "dedupe_key", "left")
    gaps = F.filter(F.array(*(F.when(F.coalesce(F.col(f"no_{n}"), F.lit(True)), F.lit(n)) for n in (*_CHILDREN, "frames"))), lambda x: x.isNotNull())
    return joined.select(F.explode(gaps).alias("child")).groupBy("child").agg(F.count("*").alias("missing"))


@query("q11_absent_recently", f"""
SELECT DISTINCT candidate_id FROM merge_candidates c WHERE NOT EXISTS (SELECT 1 FROM projection_frames f WHERE f.source_mac = c.mac_a AND f.observed_at >= TIMESTAMP '{NOW}' - INTERVAL 10 DAY)""")
def absent_recently(spark: SparkSession, d: str) -> DataFrame:
    """Candidates whose first address was not seen of late: the moment filters the right side before the join."""
    recent = table(spark, d, "projection_frames").where(f"observed_at >= {TS} - INTERVAL 10 DAYS").select(F.col("source_mac").alias("mac_a"))
    return table(spark, d, "merge_candidates").select("candidate_id", "mac_a").join(recent, "mac_a", "left_anti").select("candidate_id").distinct()


@query("q10_null_tolerant_anti", """
SELECT DISTINCT location_id, bssid FROM projection_frames e WHERE NOT EXISTS (SELECT 1 FROM wireless_authorized_networks n WHERE n.enabled AND (n.location_id IS NULL OR n.location_id = e.location_id) AND (n.bssid IS NULL OR n.bssid = e.bssid))""")
def null_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """Place and access point pairs that no authorised network covers (nulls of a pattern match all)."""
    pairs = table(spark, d, "projection_frames").select("location_id", "bssid").distinct()
    return null_tolerant_anti(pairs, table(spark, d, "wireless_authorized_networks").where("enabled"), ["location_id", "bssid"])


@query("q44_unique_match", """
WITH p AS (SELECT DISTINCT location_id, bssid FROM projection_frames WHERE bssid IS NOT NULL)
SELECT p.location_id, p.bssid, max(n.ssid) AS ssid FROM p JOIN wireless_authorized_networks n ON n.enabled AND (n.location_id IS NULL OR n.location_id = p.location_id) AND (n.bssid IS NULL OR n.bssid = p.bssid) GROUP BY 1, 2 HAVING count(*) = 1""")
def unique_match(spark: SparkSession, d: str) -> DataFrame:
    """The network of an access point, where exactly one matches."""
    pairs = table(spark, d, "projection_frames").where("bssid is not null").select("location_id", "bssid").distinct()
    return single_match(pairs, table(spark, d, "wireless_authorized_networks").where("enabled"), ["location_id", "bssid"], "ssid")


@query("q45_json_agg", """
SELECT coalesce(location_id, '-') AS location_id, to_json(list(json_object('id', id, 'ssid', ssid, 'bssid', bssid, 'location_id', location_id, 'label', label) ORDER BY id)) AS networks FROM wireless_authorized_networks WHERE enabled GROUP BY 1""")
def json_agg(spark: SparkSession, d: str) -> DataFrame:
    """Authorised networks of a place as one JSON array; null members are kept."""
    one = F.struct("id", "ssid", "bssid", "location_id", "label")
    g = table(spark, d, "wireless_authorized_networks").where("enabled").groupBy(F.coalesce("location_id", F.lit("-")).alias("place"))
    return g.agg(F.to_json(F.array_sort(F.collect_list(one)), {"ignoreNullFields": "false"}).alias("networks")).withColumnRenamed("place", "location_id")


@query("q45b_pending_count", "SELECT stream_name, count(*) AS pending FROM (SELECT DISTINCT stream_name, dedupe_key FROM sync_events WHERE status IN ('pending', 'failed', 'batched')) GROUP BY 1")
def pending_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sync_events").where("status in ('pending', 'failed', 'batched')").select("stream_name", "dedupe_key").distinct().groupBy("stream_name").agg(F.count("*").alias("pending"))


@query("q45c_audit_request_keys", "SELECT DISTINCT dedupe_key, sha256('proxy.payload_audit:' || sha256(payload)) AS audit_key, 'sha256://' || sha256(payload) AS payload_ref FROM sync_events WHERE payload IS NOT NULL")
def audit_request_keys(spark: SparkSession, d: str) -> DataFrame:
    """Scan requests of raw audit records: key and hash reference."""
    digest = sha256(F.col("payload"))
    return table(spark, d, "sync_events").where("payload is not null").select("dedupe_key", F.sha2(F.concat(F.lit("proxy.payload_audit:"), digest), 256).alias("audit_key"), F.concat(F.lit("sha256://"), digest).alias("payload_ref")).distinct()


@query("q45d_hash_lookup", """
SELECT b.delivery_id, min(e.dedupe_key) AS found_key FROM broker_records b JOIN sync_events e ON e.payload_sha256 = b.payload_sha256 AND e.payload IS NOT NULL GROUP BY 1""")
def hash_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The first message whose payload has a delivery's digest; the lookup side is folded first."""
    known = table(spark, d, "sync_events").where("payload is not null").groupBy("payload_sha256").agg(F.min("dedupe_key").alias("found_key"))
    return table(spark, d, "broker_records").select("delivery_id", "payload_sha256").join(known, "payload_sha256").select("delivery_id", "found_key")


@query("q45e_archive_path", f"""
SELECT DISTINCT dedupe_key, 'wireless/' || strftime(observed_at, '%Y/%m/%d') || '/' || dedupe_key || '.json' AS object_key, sha256(payload) = payload_sha256 AS verified
FROM sync_events WHERE stream_name = 'wireless.audit' AND payload IS NOT NULL AND observed_at < TIMESTAMP '{NOW}' - INTERVAL 7 DAY""")
def archive_path(spark: SparkSession, d: str) -> DataFrame:
    """Archive candidates older than the hot days, with object key and hash check."""
    rows = table(spark, d, "sync_events").where(f"stream_name = 'wireless.audit' and payload is not null and observed_at < {TS} - INTERVAL 7 DAYS")
    path = F.concat(F.lit("wireless/"), F.date_format("observed_at", "yyyy/MM/dd"), F.lit("/"), F.col("dedupe_key"), F.lit(".json"))
    return rows.select("dedupe_key", path.alias("object_key"), (sha256(F.col("payload")) == F.col("payload_sha256")).alias("verified")).distinct()
