"""Load, result and service consumers: each turns a micro-batch into tables, replies and dead letters.

A handler is a function of DataFrames, so a batch run again gives the same rows; ``drain``
writes what it returns into folders of the epoch, which are overwritten.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.ids import sha256
from skysift.functions.jsonx import present_text
from skysift.operators.merge import merge_rows
from skysift.session import exists

# Stages at which a message can have failed, and the reply topic every sensor may name.
STAGES = ("pre_publish", "post_publish")
SENSOR_INBOX = "_INBOX.sensor"

Handler = Callable[[DataFrame], dict[str, DataFrame]]


def drain(source: DataFrame, handler: Handler, out: str, checkpoint: str) -> None:
    """Run a stream to its end; each table a handler returns is appended under ``out/name``, one folder an epoch."""

    def body(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        for name, rows in handler(batch).items():
            rows.write.mode("overwrite").parquet(f"{out}/{name}/epoch={epoch}")
        batch.unpersist()

    source.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """What a stream has written so far; an empty table before its first epoch."""
    return spark.read.parquet(path).drop("epoch") if exists(spark, path) else spark.createDataFrame([], schema)


def refused(rows: DataFrame, operation: str) -> DataFrame:
    """Dead letters of rows with an error."""
    body = F.to_json(F.struct("error", F.lit("permanent").alias("error_class"), F.lit(operation).alias("operation"), F.col("value").alias("original")))
    return rows.where("error is not null").select(F.col("key").alias("key"), body.alias("value"))


def load(batch: DataFrame, transforms: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]]) -> dict[str, DataFrame]:
    """Load messages ``(stream_name, dedupe_key, payload)``: typed rows by sink, and one result for each message.

    ``transforms``: by sink, the stream that feeds it and what turns messages into rows. A
    message whose rows lack something required fails for good and none of its rows is kept;
    one that is not readable fails too.
    """
    out, counts = {}, None
    for name, (stream, f) in transforms.items():
        typed = f(batch.where(F.col("stream_name") == stream)).withColumn("stream_name", F.lit(stream))
        sums = typed.groupBy("stream_name", "dedupe_key").agg(F.count("*").alias("rows"), F.min("error").alias("error"))
        counts = sums if counts is None else counts.unionByName(sums)
        out[name] = typed.join(sums.where("error is not null").select("dedupe_key"), "dedupe_key", "left_anti").drop("error")
    asked = batch.select("stream_name", "dedupe_key").distinct()
    done = asked.join(counts, ["stream_name", "dedupe_key"], "left")
    fine = F.col("rows").isNotNull() & F.col("error").isNull()
    out["results"] = done.select(
        F.col("stream_name").alias("job_id"), F.col("dedupe_key").alias("batch_id"), F.when(fine, "success").otherwise("failed").alias("status"), F.when(fine, F.col("rows")).otherwise(0).alias("row_count"),
        F.when(fine, "").otherwise("permanent").alias("error_class"), F.when(fine, "").otherwise(F.coalesce(F.concat(F.lit("missing "), "error"), F.lit("no readable record"))).alias("error_text"),
    )
    return out


def identified(requests: DataFrame) -> DataFrame:
    """Backlog requests with dedupe_key, stream_name, and what is wrong with them."""
    v = F.try_parse_json("value")
    r = requests.withColumn("v", v).withColumn("dedupe_key", present_text(F.col("v"), "$.dedupe_key")).withColumn("stream_name", present_text(F.col("v"), "$.stream_name"))
    wrong = F.when(F.col("v").isNull(), "not JSON")
    for c in ("dedupe_key", "stream_name"):
        wrong = wrong.when(F.coalesce(F.col(c), F.lit("")) == "", f"blank {c}")
    return r.withColumn("error", wrong)


def saves(requests: DataFrame) -> DataFrame:
    """Backlog entries to save; the payload is a member, or the whole request."""
    r = identified(requests).withColumn("stage", F.coalesce(present_text(F.col("v"), "$.failure_stage"), F.lit(STAGES[0])))
    payload = F.coalesce(F.to_json(F.try_variant_get("v", "$.payload", "variant")), F.col("value"))
    return r.withColumn("error", F.coalesce("error", F.when(~F.col("stage").isin(*STAGES), "invalid failure_stage"))).withColumn("payload", payload)


def valid_topic(topic: Column) -> Column:
    return topic.rlike(r"^[A-Za-z0-9._-]{1,249}\z") & ~topic.isin(".", "..")


def reply_topic(value: str, default: str, allowed: tuple[str, ...]) -> Column:
    """The topic a request wants its reply in, if that is allowed; else the default."""
    wanted = present_text(F.try_parse_json(value), "$.reply_topic")
    return F.when(valid_topic(wanted) & wanted.isin(*allowed, SENSOR_INBOX), wanted).otherwise(F.lit(default))


def apply_backlog(backlog: DataFrame, requests: DataFrame, now_us: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(backlog, replies, dead letters) after a micro-batch of ``requests(topic, key, value)``.

    Within a micro-batch entries are saved first (of several saves the greatest request
    counts), then marked as synced, then pruned; lists and counts are answered last. A synced
    entry stays synced. backlog: stream_name, dedupe_key, status, stage, payload, attempts,
    saved_us, next_us.
    """
    keys = ["stream_name", "dedupe_key"]
    of = lambda name: requests.where(F.col("topic") == name)
    save, done = saves(of("backlog.save")), identified(of("backlog.synced"))
    fresh = save.where("error is null").groupBy(*keys).agg(F.max_by(F.struct("stage", "payload"), "value").alias("x"))
    fresh = fresh.select(*keys, F.lit("pending").alias("status"), "x.stage", "x.payload", F.lit(0).cast("long").alias("attempts"), F.lit(now_us).cast("long").alias("saved_us"), F.lit(now_us).cast("long").alias("next_us"))
    sticky = lambda old, new: F.when(old == "synced", old).otherwise(new)
    after = merge_rows(backlog, fresh, keys, {"status": sticky, "attempts": "keep", "saved_us": "keep", "next_us": "keep"})
    marks = done.where("error is null").select(*keys, F.lit(True).alias("mark")).distinct()
    after = after.join(marks, keys, "left").withColumn("status", F.when(F.col("mark"), "synced").otherwise(F.col("status"))).select(*backlog.columns)
    old = (F.col("status") == "synced") & (F.col("saved_us") < now_us - 7 * 86_400_000_000)
    prune = of("backlog.prune")
    # the number pruned and the 100 oldest due entries are one row each, whatever the backlog
    pruned = after.agg(F.count_if(old).alias("pruned"))
    due = after.where(F.col("status").isin("pending", "sync_failed") & (F.col("next_us") <= now_us)).orderBy("saved_us", *keys).limit(100)
    entry = F.struct("saved_us", "stream_name", "dedupe_key", "payload", F.col("stage").alias("failure_stage"), F.col("attempts").alias("attempt_count"))
    listed = due.agg(F.array_sort(F.collect_list(entry)).alias("e")).select(F.to_json(F.struct(F.transform("e", lambda x: F.struct(x["dedupe_key"].alias("dedupe_key"), x["stream_name"].alias("stream_name"), x["payload"].alias("payload"), x["failure_stage"].alias("failure_stage"), x["attempt_count"].alias("attempt_count"))).alias("entries"))).alias("reply"))
    answers = of("backlog.list").join(F.broadcast(listed)).select(reply_topic("value", "backlog.replies", ()).alias("topic"), "key", F.col("reply").alias("value"))
    counts = prune.join(F.broadcast(pruned)).select(reply_topic("value", "backlog.replies", ()).alias("topic"), "key", F.to_json(F.struct("pruned", F.lit(7).alias("retention_days"))).alias("value"))
    wanted = prune.limit(1).select(F.lit(True).alias("wanted"))
    kept = after.withColumn("old", old).join(F.broadcast(wanted), F.col("old"), "left").where("wanted is null").select(*backlog.columns)
    return kept, answers.unionByName(counts), refused(save, "backlog_save").unionByName(refused(done, "backlog_synced"))


def device_replies(requests: DataFrame, devices: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Replies to address lookups; requests without a valid address and unknown devices get none.

    ``devices(mac_id, username, display_name, hostname)``.
    """
    mac = F.lower(F.trim(present_text(F.try_parse_json("value"), "$.mac")))
    asked = requests.where(F.col("topic") == "mac.lookup").withColumn("mac_id", F.when(mac.rlike(r"^[0-9a-f]{2}(:[0-9a-f]{2}){5}\z"), mac))
    body = F.to_json(F.struct(F.col("mac_id").alias("device_id"), "username", "display_name", "hostname"), {"ignoreNullFields": "false"})
    return asked.join(devices, "mac_id").select(reply_topic("value", "lookup.replies", allowed).alias("topic"), "key", body.alias("value"))


def network_replies(requests: DataFrame, networks: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Replies with all enabled networks as one array; null members are kept."""
    one = F.struct("ssid", F.lower("bssid").alias("bssid"), "location_id", "label", "enabled")
    every = networks.where("enabled").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("id", one.alias("n")))), lambda x: x["n"]), {"ignoreNullFields": "false"}).alias("reply"))
    asked = requests.where((F.col("topic") == "networks.request") & (F.col("value") != ""))
    return asked.join(F.broadcast(every)).select(reply_topic("value", "network.replies", allowed).alias("topic"), "key", F.col("reply").alias("value"))


def resolved(decoded: DataFrame, known: DataFrame, outbox_root: str | None = None) -> DataFrame:
    """Scan requests with their payload and what is wrong: inline, by file, or by digest from ``known(payload_sha256, payload)``.

    A file reference must stay below the outbox: no absolute path and no ``..``. A payload must
    be JSON and not null.
    """
    from skysift.streaming.ingest import inline_payload

    ref = F.col("payload_ref")
    name = F.regexp_extract(ref, r"^outbox://(.+)\z", 1)
    leaves = name.startswith("/") | F.concat(F.lit("/"), name, F.lit("/")).contains("/../")
    rows = decoded.withColumn("inline", inline_payload(ref)).withColumn("digest", F.regexp_extract(ref, r"^sha256://([0-9a-f]{64})\z", 1)).withColumn("file", F.when((name != "") & ~leaves, name))
    rows = rows.join(known.select(F.col("payload_sha256").alias("digest"), F.col("payload").alias("by_digest")).dropDuplicates(["digest"]), "digest", "left")
    if outbox_root:
        root = outbox_root.rstrip("/")
        files = decoded.sparkSession.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
        files = files.select(F.regexp_replace(F.col("_metadata.file_path"), r"^[a-z]+:/+", "/").alias("path"), F.col("value").alias("by_file"))
        files = files.select(F.expr(f"substring(path, {len(root.removeprefix('file:').replace('//', '/')) + 2})").alias("file"), "by_file")
        rows = rows.join(files, "file", "left")
    else:
        rows = rows.withColumn("by_file", F.lit(None).cast("string"))
    text = F.coalesce("inline", "by_file", "by_digest")
    fine = F.try_parse_json(text).isNotNull() & (F.trim(text) != "null")
    wrong = F.coalesce("error", F.when(leaves, "payload_ref leaves the outbox"), F.when(~F.coalesce(fine, F.lit(False)), "payload cannot be resolved"))
    return rows.withColumn("payload", F.when(fine, text)).withColumn("error", wrong).drop("inline", "digest", "file", "by_digest", "by_file")


def evidence(requests: DataFrame, ledger_keys: DataFrame, group: str) -> DataFrame:
    """One row for each position: digest, key, and whether the message was processed, a duplicate, or refused."""
    keys = ["stream_name", "dedupe_key"]
    order = F.struct("topic", "partition", "offset")
    first = requests.where("error is null").groupBy(*keys).agg(F.min(order).alias("first"))
    seen = ledger_keys.select(*keys).distinct().withColumn("seen", F.lit(True))
    r = requests.join(first, keys, "left").join(seen, keys, "left")
    what = F.when(F.col("error").isNotNull(), "dead_lettered").when(F.col("seen") | (order != F.col("first")), "duplicate").otherwise("processed")
    return r.select(F.lit(group).alias("consumer_group"), "topic", "partition", "offset", *keys, sha256(F.col("payload")).alias("payload_sha256"), what.alias("disposition"))


def probe_merge(clients: DataFrame, rows: DataFrame, batch_id: str) -> DataFrame:
    """Clients after a flush of probe rows: times least and greatest, counts added once a batch, known values kept."""
    from skysift.operators.merge import add_unless

    folded = rows.groupBy("ssid", "client_mac").agg(F.max("known_bssid").alias("known_bssid"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("probe_count").alias("probe_count")).withColumn("last_batch", F.lit(batch_id))
    return merge_rows(clients, folded.select(*clients.columns), ["ssid", "client_mac"], {"known_bssid": "coalesce_new", "first_seen": "least", "last_seen": "greatest", "probe_count": add_unless("last_batch")})


def fan_in(handlers: dict[str, Handler]) -> Handler:
    """One handler of several: each sees the whole batch, equal tables are put together."""

    def run(batch: DataFrame) -> dict[str, DataFrame]:
        out: dict[str, DataFrame] = {}
        for handler in handlers.values():
            for name, rows in handler(batch).items():
                out[name] = out[name].unionByName(rows) if name in out else rows
        return out

    return run


