"""Jobs and batches, outbox, retention, hydration, run logs, anchors and metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skysift.functions.ids import stable_id
from skysift.functions.mac import epoch_us
from skysift.operators.merge import insert_only, merge_rows
from skysift.plans import ledger
from skysift.plans.frames import stable_sql
from skysift.plans.identity import _KNN, _neighbours
from skysift.plans.registry import NOW, Registry
from skysift.schemas import TABLES
from skysift.sources.tables import table

query = Registry()
TS, NOW_SQL = f"timestamp_ntz'{NOW}'", f"TIMESTAMP '{NOW}'"
KEYS = ["stream_name", "dedupe_key"]

_PLAN = ledger.query.oracles["q48_job_planner"]
_JOB, _BATCH = stable_sql("job", "stream_name", "dedupe_key"), stable_sql("batch", "stream_name", "dedupe_key", "CAST(batch_no AS VARCHAR)")


def jobs_and_batches(plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A planned message's job row and batch row; ids follow from the message, so that planning again gives the same rows."""
    job = stable_id("job", F.col("stream_name"), F.col("dedupe_key")).alias("job_id")
    batch = stable_id("batch", F.col("stream_name"), F.col("dedupe_key"), F.col("batch_no").cast("string")).alias("batch_id")
    jobs = plan.select(job, *KEYS, F.lit("pending").alias("status"))
    return jobs, plan.select(batch, job, *KEYS, "batch_no", "payload_ref", "cursor_start", "cursor_end", F.lit("pending").alias("status"))


@query("q48d_jobs", f"WITH p AS ({_PLAN}) SELECT {_JOB} AS job_id, stream_name, dedupe_key, 'pending' AS status FROM p")
def jobs(spark: SparkSession, d: str) -> DataFrame:
    """Jobs after planning twice: inserted only where there is none."""
    rows = jobs_and_batches(ledger.job_planner(spark, d))[0]
    return insert_only(rows, rows, ["job_id"])


@query("q48e_batches", f"WITH p AS ({_PLAN}) SELECT {_BATCH} AS batch_id, {_JOB} AS job_id, stream_name, dedupe_key, batch_no, payload_ref, cursor_start, cursor_end, 'pending' AS status FROM p")
def batches(spark: SparkSession, d: str) -> DataFrame:
    rows = jobs_and_batches(ledger.job_planner(spark, d))[1]
    return insert_only(rows.where("payload_ref is null"), rows, ["batch_id"])


@query("q48f_job_batches", f"WITH p AS ({_PLAN}) SELECT {_JOB} AS job_id, {_BATCH} AS batch_id, stream_name, cursor_end FROM p")
def job_batches(spark: SparkSession, d: str) -> DataFrame:
    """Jobs joined to their batches on message and stream."""
    j, b = jobs_and_batches(ledger.job_planner(spark, d))
    return j.select("job_id", *KEYS).join(b.select("batch_id", *KEYS, "cursor_end"), KEYS).select("job_id", "batch_id", "stream_name", "cursor_end")


@query("q41b_cursor_initialise", """
SELECT stream_name, coalesce(max(dedupe_key) FILTER (WHERE status = 'done' AND stream_name LIKE 'wireless%'), '0') AS cursor_value FROM sync_events GROUP BY 1""")
def cursor_initialise(spark: SparkSession, d: str) -> DataFrame:
    """Cursors of all streams: those without one begin at 0."""
    e = table(spark, d, "sync_events")
    stored = e.where("status = 'done' and stream_name like 'wireless%'").groupBy("stream_name").agg(F.max("dedupe_key").alias("cursor_value"))
    return insert_only(stored, e.select("stream_name").distinct().withColumn("cursor_value", F.lit("0")), ["stream_name"])


def _due() -> Column:
    """When a row may be tried again: doubling minutes after its last update, an hour at most."""
    minutes = F.least(F.pow(F.lit(2.0), F.col("attempt_count")), F.lit(60.0)).cast("int")
    return F.timestamp_seconds(F.unix_seconds(F.col("updated_at").cast("timestamp")) + minutes * 60)


_DUE_SQL = "date_trunc('second', updated_at) + to_minutes(CAST(least(pow(2, attempt_count), 60) AS INTEGER))"


@query("q36b_outbox_due", f"""
SELECT DISTINCT stream_name, dedupe_key, epoch_us(updated_at) AS updated_us, attempt_count FROM sync_events WHERE status IN ('pending', 'failed') AND {_DUE_SQL} <= TIMESTAMP '2021-01-16 00:00:00' ORDER BY updated_us, stream_name, dedupe_key, attempt_count LIMIT 50""")
def outbox_due(spark: SparkSession, d: str) -> DataFrame:
    """The 50 rows longest due at a moment (the limit is the feature: one drain of the outbox)."""
    due = table(spark, d, "sync_events").where("status in ('pending', 'failed')").where(_due() <= F.expr("timestamp'2021-01-16 00:00:00 UTC'"))
    rows = due.select(*KEYS, epoch_us(F.col("updated_at")).alias("updated_us"), "attempt_count").distinct()
    return rows.orderBy("updated_us", *KEYS, "attempt_count").limit(50)


@query("q36c_outbox_states", f"""
SELECT DISTINCT stream_name, dedupe_key, updated_at, attempt_count, CASE WHEN status = 'done' THEN 'published' WHEN payload IS NULL AND payload_ref IS NULL THEN 'parked' WHEN status = 'batched' AND updated_at <= {NOW_SQL} - INTERVAL 1 DAY THEN 'pending' WHEN status = 'batched' THEN 'claimed'
 WHEN attempt_count >= 4 THEN 'failed' WHEN {_DUE_SQL} <= {NOW_SQL} THEN 'claimed' ELSE 'pending' END AS state_after FROM sync_events""")
def outbox_states(spark: SparkSession, d: str) -> DataFrame:
    """The ledger as an outbox after one turn: due rows are claimed, malformed ones parked, expired claims returned, spent ones failed."""
    spent = F.col("attempt_count") >= 4
    old = F.col("updated_at") <= F.expr(f"{TS} - INTERVAL 1 DAY")
    after = (
        F.when(F.col("status") == "done", "published").when(F.col("payload").isNull() & F.col("payload_ref").isNull(), "parked").when((F.col("status") == "batched") & old, "pending").when(F.col("status") == "batched", "claimed")
        .when(spent, "failed").when(_due() <= F.expr(f"timestamp'{NOW} UTC'"), "claimed").otherwise("pending")
    )
    return table(spark, d, "sync_events").select(*KEYS, "updated_at", "attempt_count", after.alias("state_after")).distinct()


_ELIGIBLE = ledger.query.oracles["q15_retention_eligible"]


def cascade(keys: DataFrame, tables: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, DataFrame]:
    """Tables without the rows of deleted messages: each deletion is an anti-join."""
    return {name: df.join(keys.select(*on).distinct(), on, "left_anti") for name, (df, on) in tables.items()}


@query("q15c_retention_cascade", f"""
WITH g AS ({_ELIGIBLE}) SELECT 'sync_events' AS name, count(*) AS kept FROM sync_events t WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.stream_name = t.stream_name AND g.dedupe_key = t.dedupe_key)
UNION ALL SELECT 'broker_records', count(*) FROM broker_records t WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.stream_name = t.stream_name AND g.dedupe_key = t.dedupe_key)
UNION ALL SELECT 'projection_frames', count(*) FROM projection_frames t WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.dedupe_key = t.dedupe_key)""")
def retention_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Rows left after the eligible messages are deleted with everything that belongs to them."""
    left = cascade(ledger.retention_eligible(spark, d), {n: (table(spark, d, n), on) for n, on in (("sync_events", KEYS), ("broker_records", KEYS), ("projection_frames", ["dedupe_key"]))})
    counts = [df.agg(F.count("*").alias("kept")).select(F.lit(n).alias("name"), "kept") for n, df in left.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("q15d_tombstones", f"""
WITH g AS (SELECT stream_name, dedupe_key, {NOW_SQL} + INTERVAL 45 DAY AS expires_at FROM ({_ELIGIBLE})), t AS (SELECT stream_name, dedupe_key, max(observed_at) + INTERVAL 15 DAY AS expires_at FROM sync_events WHERE payload IS NULL GROUP BY 1, 2)
SELECT stream_name, dedupe_key, epoch_us(max(expires_at)) AS expires_us FROM (SELECT * FROM g UNION ALL SELECT * FROM t) GROUP BY 1, 2""")
def tombstones_written(spark: SparkSession, d: str) -> DataFrame:
    """Tombstones after a retention run: a deleted message's key is barred for 45 days, or longer if it was."""
    fresh = ledger.retention_eligible(spark, d).select(*KEYS, F.expr(f"{TS} + INTERVAL 45 DAYS").alias("expires_at")).distinct()
    m = merge_rows(ledger.tombstones(spark, d), fresh, KEYS, {"expires_at": "greatest"})
    return m.select(*KEYS, epoch_us(F.col("expires_at")).alias("expires_us"))


@query("q43i_hydration_plan", f"""
WITH e AS (SELECT stream_name, dedupe_key, max(payload) IS NULL AS lacks, bool_or(coalesce(payload_ref, '') LIKE 'archive://%') AS archived, min(payload_sha256) AS sha FROM sync_events GROUP BY 1, 2),
t AS (SELECT stream_name, dedupe_key FROM sync_events WHERE payload IS NULL GROUP BY 1, 2 HAVING max(observed_at) + INTERVAL 15 DAY > {NOW_SQL}), h AS (SELECT payload_sha256, min(dedupe_key) AS found FROM sync_events WHERE payload IS NOT NULL GROUP BY 1)
SELECT e.stream_name, e.dedupe_key, CASE WHEN archived THEN 'archived' WHEN t.dedupe_key IS NOT NULL THEN 'tombstoned' WHEN h.found IS NOT NULL THEN 'hydrated' ELSE 'missing' END AS outcome, CASE WHEN NOT archived AND t.dedupe_key IS NULL THEN h.found END AS source_key
FROM e LEFT JOIN t ON t.stream_name = e.stream_name AND t.dedupe_key = e.dedupe_key LEFT JOIN h ON h.payload_sha256 = e.sha WHERE lacks""")
def hydration_plan(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of each message without a payload: one batch instead of a paged repair loop."""
    e = table(spark, d, "sync_events")
    rows = e.groupBy(*KEYS).agg(F.max("payload").isNull().alias("lacks"), F.bool_or(F.coalesce(F.col("payload_ref").startswith("archive://"), F.lit(False))).alias("archived"), F.min("payload_sha256").alias("payload_sha256")).where("lacks")
    barred = ledger.tombstones(spark, d).where(f"expires_at > {TS}").select(*KEYS, F.lit(True).alias("barred"))
    known = e.where("payload is not null").groupBy("payload_sha256").agg(F.min("dedupe_key").alias("found"))
    joined = rows.join(barred, KEYS, "left").join(known, "payload_sha256", "left")
    outcome = F.when(F.col("archived"), "archived").when(F.col("barred"), "tombstoned").when(F.col("found").isNotNull(), "hydrated").otherwise("missing")
    return joined.select(*KEYS, outcome.alias("outcome"), F.when(~F.col("archived") & F.col("barred").isNull(), F.col("found")).alias("source_key"))


@query("q43f_hydration_update", f"""
WITH e AS (SELECT stream_name, dedupe_key, min(payload) AS payload, min(payload_sha256) AS sha, bool_or(coalesce(payload_ref, '') LIKE 'archive://%') AS archived FROM sync_events GROUP BY 1, 2),
t AS (SELECT stream_name, dedupe_key FROM sync_events WHERE payload IS NULL GROUP BY 1, 2 HAVING max(observed_at) + INTERVAL 15 DAY > {NOW_SQL})
SELECT b.delivery_id, (e.payload IS NULL OR e.sha = b.payload_sha256) AND NOT archived AND t.dedupe_key IS NULL AS applies FROM broker_records b JOIN e ON e.stream_name = b.stream_name AND e.dedupe_key = b.dedupe_key LEFT JOIN t ON t.stream_name = b.stream_name AND t.dedupe_key = b.dedupe_key""")
def hydration_update(spark: SparkSession, d: str) -> DataFrame:
    """Whether a delivery may set a message's payload: none is stored or the same one, and it is neither archived nor barred."""
    archived = F.bool_or(F.coalesce(F.col("payload_ref").startswith("archive://"), F.lit(False))).alias("archived")
    e = table(spark, d, "sync_events").groupBy(*KEYS).agg(F.min("payload").alias("payload"), F.min("payload_sha256").alias("sha"), archived)
    barred = ledger.tombstones(spark, d).where(f"expires_at > {TS}").select(*KEYS, F.lit(True).alias("barred"))
    joined = table(spark, d, "broker_records").join(e, KEYS).join(barred, KEYS, "left")
    fits = F.col("payload").isNull() | (F.col("sha") == F.col("payload_sha256"))
    return joined.select("delivery_id", (fits & ~F.col("archived") & F.col("barred").isNull()).alias("applies"))


@query("q43j_ordered_delete", """
SELECT DISTINCT stream_name, dedupe_key FROM sync_events EXCEPT SELECT stream_name, dedupe_key FROM (SELECT stream_name, dedupe_key, min(updated_at) AS u FROM sync_events WHERE status = 'done' GROUP BY 1, 2 ORDER BY u, stream_name, dedupe_key LIMIT 100)""")
def ordered_delete(spark: SparkSession, d: str) -> DataFrame:
    """Messages left after the 100 oldest finished ones are pruned (the limit is the feature)."""
    e = table(spark, d, "sync_events")
    oldest = e.where("status = 'done'").groupBy(*KEYS).agg(F.min("updated_at").alias("u")).orderBy("u", *KEYS).limit(100)
    return e.select(*KEYS).distinct().join(oldest, KEYS, "left_anti")


@query("q48g_run_log", f"""
SELECT {stable_sql('run', 'stream_name', "CAST(CAST(updated_at AS DATE) AS VARCHAR)")} AS run_id, stream_name AS processor, epoch_us(min(created_at)) AS started_us, epoch_us(max(updated_at)) AS finished_us, count(*) AS seen, count(*) FILTER (WHERE status = 'failed') AS failed,
 CASE WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed' ELSE 'completed' END AS outcome FROM sync_events GROUP BY stream_name, CAST(updated_at AS DATE)""")
def run_log(spark: SparkSession, d: str) -> DataFrame:
    """One run row per stream and day of the ledger: when, how much, how it ended."""
    failed = F.count_if(F.col("status") == "failed")
    g = table(spark, d, "sync_events").groupBy("stream_name", F.col("updated_at").cast("date").cast("string").alias("day")).agg(epoch_us(F.min("created_at")).alias("started_us"), epoch_us(F.max("updated_at")).alias("finished_us"), F.count("*").alias("seen"), failed.alias("failed"))
    return g.select(stable_id("run", F.col("stream_name"), F.col("day")).alias("run_id"), F.col("stream_name").alias("processor"), "started_us", "finished_us", "seen", "failed", F.when(F.col("failed") > 0, "failed").otherwise("completed").alias("outcome"))


@query("q16c_neighbour_documents", f"""
WITH {_KNN} SELECT k.query_id, k.id, l.source AS left_source, r.source AS right_source, round(distance, 6) AS distance FROM k JOIN documents l ON l.doc_id = k.query_id JOIN documents r ON r.doc_id = k.id WHERE k.rank <= 8""")
def neighbour_documents(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours with the documents of both vectors."""
    side = lambda c, name: table(spark, d, "documents").select(F.col("doc_id").alias(c), F.col("source").alias(name))
    near = _neighbours(spark, d, 8).join(side("query_id", "left_source"), "query_id").join(side("id", "right_source"), "id")
    return near.select("query_id", "id", "left_source", "right_source", F.round("distance", 6).alias("distance"))


ANCHORS, LIMIT = 20, 25


@query("q16d_anchor_pairs", f"""
WITH a AS (SELECT vec_id, embedding FROM embeddings ORDER BY vec_id DESC LIMIT {ANCHORS}),
k AS (SELECT a.vec_id AS anchor, v.vec_id AS other, 1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) AS distance, row_number() OVER (PARTITION BY a.vec_id ORDER BY 1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), v.vec_id) AS rank FROM a, embeddings v WHERE v.vec_id <> a.vec_id),
f AS (SELECT anchor, other, distance, row_number() OVER (PARTITION BY least(anchor, other), greatest(anchor, other) ORDER BY anchor DESC) AS once FROM k WHERE rank <= least(2 * {LIMIT}, 64) AND distance <= 0.9)
SELECT anchor, other, round(distance, 6) AS distance FROM f WHERE once = 1 ORDER BY anchor DESC, distance, other LIMIT {LIMIT}""")
def anchor_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of the newest anchors, newest first, each unordered pair once, up to a limit (the limits are the feature).

    An anchor looks at twice as many candidates as are wanted, 64 at most.
    """
    from skysift.operators.knn import nearest

    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    near = nearest(v, v.orderBy(F.desc("id")).limit(ANCHORS), min(2 * LIMIT, 64)).where("distance <= 0.9")
    once = F.row_number().over(Window.partitionBy(F.least("query_id", "id"), F.greatest("query_id", "id")).orderBy(F.desc("query_id")))
    kept = near.withColumn("once", once).where("once = 1").orderBy(F.desc("query_id"), "distance", "id").limit(LIMIT)
    return kept.select(F.col("query_id").alias("anchor"), F.col("id").alias("other"), F.round("distance", 6).alias("distance"))


@query("q32c_text_functions", """
SELECT delivery_id, split_part(dedupe_key, '-', 1) AS head, array_to_string(string_split(stream_name, '.')[-1:], '.') AS tail, '[' || partition_id || ',' || record_offset || ']' AS as_text, CAST(partition_id + record_offset AS DOUBLE) AS total, true AS fresh FROM broker_records""")
def text_functions(spark: SparkSession, d: str) -> DataFrame:
    """Parts of a text up to and after a mark, vectors as text and back, and fresh ids (told apart, not compared)."""
    pair = F.array(F.col("partition_id").cast("long"), F.col("record_offset"))
    as_text = F.to_json(pair)
    back = F.from_json(as_text, T.ArrayType(T.DoubleType()))
    return table(spark, d, "broker_records").select(
        "delivery_id", F.substring_index("dedupe_key", "-", 1).alias("head"), F.substring_index("stream_name", ".", -1).alias("tail"), as_text.alias("as_text"), F.aggregate(back, F.lit(0.0), lambda s, x: s + x).alias("total"),
        F.uuid().rlike(r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z").alias("fresh"),
    )


@query("q51_metadata", f"SELECT table_name, column_name FROM information_schema.columns WHERE table_name IN {tuple(TABLES)}")
def metadata(spark: SparkSession, d: str) -> DataFrame:
    """Tables and columns of a data set, from the files' own schemas."""
    rows = [(name, c) for name in TABLES for c in table(spark, d, name).columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")
