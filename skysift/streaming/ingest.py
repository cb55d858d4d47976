"""Structured Streaming ingest: decode, dead letters, payloads, dedupe, windows."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skysift.functions.ids import sha256
from skysift.functions.jsonx import instant, present_text
from skysift.session import exists

# Length limits of a scan request.
LIMITS = {"stream_name": 255, "dedupe_key": 255}
PAYLOAD_REF_BYTES = 16_777_215


def decode_requests(records: DataFrame, streams: tuple[str, ...]) -> DataFrame:
    """Scan requests of ``records(topic, partition, offset, key, value)`` with an ``error`` column.

    A request needs four text members within their limits, an instant with an offset, a stream
    that is configured, and, for audit messages, a key equal to the payload digest in its
    reference if that names one. The first thing wrong is the error.
    """
    v = F.try_parse_json("value")
    r = records.withColumn("v", v)
    for c in ("stream_name", "dedupe_key", "payload_ref", "observed_at"):
        r = r.withColumn(c, present_text(F.col("v"), f"$.{c}"))
    wrong = F.when(F.col("v").isNull(), "not JSON")
    for c in ("stream_name", "dedupe_key", "payload_ref", "observed_at"):
        wrong = wrong.when(F.coalesce(F.trim(c), F.lit("")) == "", f"{c} is missing")
    for c, most in LIMITS.items():
        wrong = wrong.when(F.char_length(c) > most, f"{c} is too long")
    wrong = wrong.when(F.octet_length("payload_ref") > PAYLOAD_REF_BYTES, "payload_ref is too long").when(instant(F.col("observed_at")).isNull(), "observed_at is no instant")
    wrong = wrong.when(~F.col("stream_name").isin(*streams), "stream is not configured")
    named = F.regexp_extract("payload_ref", r"^sha256://([0-9a-f]{64})\z", 1)
    wrong = wrong.when((F.col("stream_name") == "wireless.audit") & (named != "") & (named != F.col("dedupe_key")), "key differs from the payload digest")
    return r.withColumn("error", wrong).withColumn("observed_at", instant(F.col("observed_at"))).withColumn("event_sha256", sha256(F.col("value"))).drop("v")


def dead_letters(decoded: DataFrame, group: str) -> DataFrame:
    """Envelopes of bad records; the key is the message key or partition:offset."""
    bad = decoded.where("error is not null")
    body = F.to_json(F.struct(F.lit(group).alias("consumer_group"), "error", F.lit("permanent").alias("error_class"), "offset", F.col("value").alias("original"), "partition", "topic"))
    return bad.select(F.coalesce(F.nullif("key", F.lit("")), F.concat_ws(":", "partition", "offset")).alias("key"), body.alias("value"))


def inline_payload(ref: Column) -> Column:
    """The JSON text of an ``inline://json/`` reference (base64url, padding optional); else null."""
    body = F.translate(F.regexp_extract(ref, r"^inline://json/([A-Za-z0-9_\-=]+)\z", 1), "-_=", "+/")
    padded = F.rpad(body, (F.ceil(F.length(body) / 4) * 4).cast("int"), "=")
    text = F.decode(F.try_to_binary(padded, F.lit("base64")), "UTF-8")
    return F.when((body != "") & F.try_parse_json(text).isNotNull() & (F.trim(text) != "null"), text)


def outbox_path(root: str, ref: str) -> str:
    """The file an ``outbox://`` reference names; leaving ``root`` is an error."""
    name = ref.removeprefix("outbox://")
    clean = posixpath.normpath(name)
    if not ref.startswith("outbox://") or not name or name.startswith("/") or clean == ".." or clean.startswith("../") or ".." in name.split("/"):
        raise ValueError(f"bad outbox reference {ref!r}")
    return posixpath.join(root, clean)


def append_new(batch: DataFrame, epoch: int, ledger: str, keys: list[str], order: list[str], tombstones: DataFrame | None = None) -> None:
    """The body of ``foreachBatch``: append messages the ledger does not hold.

    An epoch has a folder of its own that is overwritten, and its keys are compared with the
    folders of other epochs only: running an epoch again gives the same ledger.
    """
    spark = batch.sparkSession
    first = batch.groupBy(*keys).agg(F.min_by(F.struct(*batch.columns), F.struct(*order)).alias("row")).select("row.*")
    if exists(spark, ledger):
        seen = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("epoch", T.LongType())])).parquet(ledger).where(F.col("epoch") != epoch).select(*keys)
        first = first.join(seen, keys, "left_anti")
    if tombstones is not None:
        first = first.join(tombstones.select(*keys), keys, "left_anti")
    first.write.mode("overwrite").parquet(f"{ledger}/epoch={epoch}")


def run_ledger(source: DataFrame, ledger: str, checkpoint: str, keys: list[str], order: list[str], tombstones: DataFrame | None = None) -> None:
    """Drain a stream into a deduplicated ledger."""
    body = lambda batch, epoch: append_new(batch, epoch, ledger, keys, order, tombstones)
    source.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_windows(source: DataFrame, time: str, key: str, out: str, checkpoint: str, watermark: str = "30 days") -> None:
    """Hourly counts by key in update mode: a window that changes is written again, later wins."""

    def body(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    counts = source.withWatermark(time, watermark).groupBy(F.window(time, "1 hour").alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
    counts.writeStream.outputMode("update").foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_windows(spark: SparkSession, out: str, key: str) -> DataFrame:
    return spark.read.parquet(out).groupBy("window_start", key).agg(F.max_by("n", "epoch").alias("n"))
