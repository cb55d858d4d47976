"""Digests and stable identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\x1f"


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def keyed_sha256(tag: str, payload: Column) -> Column:
    """Digest of tag, a zero byte and the payload."""
    return F.sha2(F.concat(F.lit(tag), F.lit("\x00"), payload), 256)


def _dashed(h: Column) -> Column:
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def name_uuid(name: Column) -> Column:
    """Version 3 UUID of the name's bytes alone."""
    h = F.md5(name.cast("string"))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return _dashed(F.concat(F.substring(h, 1, 12), F.lit("3"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15)))


def prefixed_name_uuid(namespace: str, *parts: Column) -> Column:
    """Version 3 UUID of length-prefixed parts, the first being ``namespace:v2``."""
    cells = [F.lit(f"{namespace}:v2"), *parts]
    return name_uuid(F.concat(*(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in cells)))


def stable_id(namespace: str, *parts: Column) -> Column:
    """First 16 bytes of the SHA-256 of namespace and parts, with UUID marks 5 and a."""
    h = F.sha2(F.concat_ws(UNIT, F.lit(namespace), *parts), 256)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def source_version(digest: Column) -> Column:
    """The first 15 hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def consumer_contract(group: Column, topic: Column) -> tuple[Column, Column]:
    """(version, digest) of a consumer group named ``..-vN`` and its topic; null if not valid."""
    g, t = F.trim(group), F.trim(topic)
    version = F.regexp_extract(g, r"[-_.]v([1-9][0-9]*)\z", 1).try_cast("int")
    digest = F.sha2(F.concat(F.char_length(g), F.lit(":"), g, F.char_length(t), F.lit(":"), t), 256)
    return version, F.when(version.isNotNull() & (t != ""), digest)
