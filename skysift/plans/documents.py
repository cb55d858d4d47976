"""Search documents: text, tokens, tags, versions, jobs and stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.ids import consumer_contract, keyed_sha256, name_uuid, prefixed_name_uuid, sha256, source_version, stable_id
from skysift.functions.text import normalized, sanitized, tokens
from skysift.plans.frames import stable_sql
from skysift.plans.registry import Registry
from skysift.sources.tables import table

query = Registry()


def prepared(sources: DataFrame) -> DataFrame:
    """Search documents of ``sources(source_table, source_key, text, ...)``.

    Adds normalized_text, its digest, the document id and the version. Blank keys and texts
    without content are left out.
    """
    rows = sources.withColumn("normalized_text", normalized(F.col("text"))).where("trim(source_key) <> '' and normalized_text <> ''")
    rows = rows.withColumn("normalized_sha256", sha256(F.col("normalized_text")))
    ident = name_uuid(F.concat_ws(":", "source_table", "source_key", "normalized_sha256"))
    return rows.withColumn("document_id", ident).withColumn("source_version", source_version(F.col("normalized_sha256"))).drop("text")


def token_rows(documents: DataFrame) -> DataFrame:
    """(document_id, token, count, tf): tokens counted inside the row, nothing is shuffled."""
    found = documents.select("document_id", tokens(F.col("normalized_text")).alias("all")).withColumn("total", F.greatest(F.size("all"), F.lit(1)))
    each = found.select("document_id", "total", F.explode("all").alias("token"))
    return each.groupBy("document_id", "token").agg(F.count("*").alias("count"), (F.count("*") / F.first("total")).alias("tf"))


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.lit("documents").alias("source_table"), F.col("doc_id").cast("string").alias("source_key"), "text", "doc_id", "lang", "source", "sensor_id", "observed_at")


# Compatibility characters that SQL has to be told about; the first two are those of the test texts.
_COMPATIBLE = {"\u00a0": " ", "\ufb01": "fi", "\ufb02": "fl", "\u2026": "...", "\u2009": " ", "\u202f": " ", "\u00b2": "2", "\u00b3": "3", "\u2122": "TM"}
_NFKC = "nfc_normalize(text)"
for _c, _plain in _COMPATIBLE.items():
    _NFKC = f"replace({_NFKC}, chr({ord(_c)}), '{_plain}')"
_NORMAL = f"trim(regexp_replace(lower({_NFKC}), '\\s+', ' ', 'g'))"


@query("q31_tokens", f"""
WITH d AS (SELECT doc_id, {_NORMAL} AS t FROM documents), x AS (SELECT doc_id, unnest(regexp_extract_all(t, '[a-z0-9][a-z0-9:_./-]{{0,190}}')) AS token FROM d), n AS (SELECT doc_id, count(*) AS total FROM x GROUP BY 1)
SELECT x.doc_id, token, count(*) AS token_count, round(CAST(count(*) AS DOUBLE) / any_value(total), 9) AS tf FROM x JOIN n ON n.doc_id = x.doc_id GROUP BY 1, 2""")
def document_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Token counts and shares of all documents, whole texts."""
    t = token_rows(prepared(_docs(spark, d)).withColumn("document_id", F.col("doc_id")))
    return t.select(F.col("document_id").alias("doc_id"), "token", F.col("count").alias("token_count"), F.round("tf", 9).alias("tf"))


@query("q31c_documents", f"""
WITH d AS (SELECT doc_id, {_NORMAL} AS t FROM documents), h AS (SELECT doc_id, sha256(t) AS s, md5('documents:' || doc_id || ':' || sha256(t)) AS m FROM d WHERE t <> '')
SELECT doc_id, s AS normalized_sha256, substr(m,1,8)||'-'||substr(m,9,4)||'-3'||substr(m,14,3)||'-'||translate(substr(m,17,1),'0123456789abcdef','89ab89ab89ab89ab')||substr(m,18,3)||'-'||substr(m,21,12) AS document_id,
 CAST('0x' || substr(s, 1, 15) AS BIGINT) AS source_version FROM h""")
def documents_prepared(spark: SparkSession, d: str) -> DataFrame:
    """Digest, id and version of all documents."""
    return prepared(_docs(spark, d)).select("doc_id", "normalized_sha256", "document_id", "source_version")


@query("q32_stable_ids", f"""
SELECT c_custkey, sha256(c_name) AS digest, md5(c_name) AS md, sha256('tag' || chr(0) || c_name) AS keyed, {stable_sql('customer', 'c_name', 'c_mktsegment')} AS stable,
 (SELECT substr(m,1,8)||'-'||substr(m,9,4)||'-3'||substr(m,14,3)||'-'||translate(substr(m,17,1),'0123456789abcdef','89ab89ab89ab89ab')||substr(m,18,3)||'-'||substr(m,21,12) FROM (SELECT md5('11:customer:v2' || strlen(c_name) || ':' || c_name) AS m)) AS prefixed FROM customer""")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("c_name")
    return table(spark, d, "customer").select("c_custkey", sha256(name).alias("digest"), F.md5("c_name").alias("md"), keyed_sha256("tag", name).alias("keyed"), stable_id("customer", name, F.col("c_mktsegment")).alias("stable"), prefixed_name_uuid("customer", name).alias("prefixed"))


@query("q32b_consumer_contract", """
SELECT delivery_id, CAST(regexp_extract(g, '[-_.]v([1-9][0-9]*)$', 1) AS INTEGER) AS version, sha256(length(g) || ':' || g || length(topic) || ':' || topic) AS digest FROM (SELECT *, consumer_group || '-v' || group_version AS g FROM broker_records)""")
def contract(spark: SparkSession, d: str) -> DataFrame:
    version, digest = consumer_contract(F.concat("consumer_group", F.lit("-v"), "group_version"), F.col("topic"))
    return table(spark, d, "broker_records").select("delivery_id", version.alias("version"), digest.alias("digest"))


@query("q33_tags", """
SELECT DISTINCT doc_id, kind, value FROM (SELECT doc_id, 'lang' AS kind, lang AS value FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents UNION ALL SELECT doc_id, 'sensor_id', sensor_id FROM documents) WHERE value IS NOT NULL""")
def tags(spark: SparkSession, d: str) -> DataFrame:
    """Non-null attributes as (kind, value) rows, by one explode."""
    pairs = F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("lang", "source", "sensor_id")))
    return table(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(pairs)).alias("t")).select("doc_id", "t.kind", "t.value").where("value is not null")


@query("q34_supersede", """
WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source, md5(text) ORDER BY doc_id DESC) AS k FROM documents) SELECT doc_id, CASE WHEN k = 1 THEN 'active' ELSE 'superseded' END AS status FROM r""")
def supersede(spark: SparkSession, d: str) -> DataFrame:
    """Copies of a text within a source: the newest is active, the others superseded."""
    rows = table(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("digest"))
    newest = rows.groupBy("source", "digest").agg(F.max("doc_id").alias("doc_id")).select("doc_id", F.lit("active").alias("status"))
    return rows.select("doc_id").join(newest, "doc_id", "left").select("doc_id", F.coalesce("status", F.lit("superseded")).alias("status"))


@query("q35_missing_jobs", """
SELECT DISTINCT e.dedupe_key AS document_id, 'event' AS kind, 'all-MiniLM-L6-v2' AS model, 100 AS priority, 5 AS max_attempts FROM sync_events e WHERE e.payload IS NOT NULL AND NOT EXISTS (SELECT 1 FROM broker_records b WHERE b.dedupe_key = e.dedupe_key AND b.payload_sha256 = e.payload_sha256 AND b.message_key IS NOT NULL AND b.consumer_group IS NOT NULL)""")
def missing_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Documents without a job of this kind and model; the constants filter the right side."""
    jobs = table(spark, d, "broker_records").where("message_key is not null and consumer_group is not null").select("dedupe_key", "payload_sha256")
    e = table(spark, d, "sync_events").where("payload is not null").select("dedupe_key", "payload_sha256")
    fresh = e.join(jobs, ["dedupe_key", "payload_sha256"], "left_anti").select(F.col("dedupe_key").alias("document_id")).distinct()
    return fresh.select("document_id", F.lit("event").alias("kind"), F.lit("all-MiniLM-L6-v2").alias("model"), F.lit(100).alias("priority"), F.lit(5).alias("max_attempts"))


def _error_text(text: Column) -> Column:
    n = F.col("doc_id").cast("string")
    return F.concat(F.lit("failed at jdbc://user"), n, F.lit(":pw@db token="), n, F.lit(" Bearer a.b-"), n, F.lit("\n"), text)


@query("q47_sanitize_text", r"""
WITH t AS (SELECT doc_id, 'failed at jdbc://user' || doc_id || ':pw@db token=' || doc_id || ' Bearer a.b-' || doc_id || chr(10) || coalesce(text, '') AS x FROM documents),
a AS (SELECT doc_id, regexp_replace(x, '[\p{Cc}\p{Cf}]', '', 'g') AS x FROM t), b AS (SELECT doc_id, regexp_replace(x, '://[^/]*?:([^@/]+)@', '://[REDACTED]@', 'g') AS x FROM a),
c AS (SELECT doc_id, regexp_replace(x, '(?i)((?:authorization\s*[:=]?\s*)?Bearer\s+)([A-Za-z0-9._\-]+)', '\1[REDACTED]', 'g') AS x FROM b), e AS (SELECT doc_id, regexp_replace(x, '(?i)(password|passwd|token|secret|api[-_]?key)\s*[:=]\s*([^\s,;]+)', '\1=[REDACTED]', 'g') AS x FROM c)
SELECT doc_id, substr(trim(regexp_replace(x, '\s+', ' ', 'g')), 1, 512) AS clean FROM e""")
def sanitize_text(spark: SparkSession, d: str) -> DataFrame:
    """Error texts made of secrets and the whole text of every document; only the operator's own limit shortens them."""
    return table(spark, d, "documents").select("doc_id", sanitized(_error_text(F.coalesce("text", F.lit("")))).alias("clean"))


@query("q47b_device_lookup", """
SELECT DISTINCT lower(trim(source_mac)) AS asked, json_object('mac', lower(trim(source_mac)), 'sensor', max(sensor_id), 'note', NULL) AS reply FROM projection_frames WHERE regexp_full_match(lower(trim(source_mac)), '[0-9a-f]{2}(:[0-9a-f]{2}){5}') GROUP BY lower(trim(source_mac))""")
def device_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Replies to lookups by normalised address; null members are kept."""
    mac = F.lower(F.trim("source_mac"))
    g = table(spark, d, "projection_frames").select(mac.alias("asked"), "sensor_id").where(F.col("asked").rlike(r"^[0-9a-f]{2}(:[0-9a-f]{2}){5}\z")).groupBy("asked").agg(F.max("sensor_id").alias("sensor"))
    return g.select("asked", F.to_json(F.struct(F.col("asked").alias("mac"), "sensor", F.lit(None).cast("string").alias("note")), {"ignoreNullFields": "false"}).alias("reply"))
