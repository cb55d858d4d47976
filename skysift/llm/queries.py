"""Queries of the training-data problems and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.mac import canonical_mac
from skysift.llm.digests import exact_ranks, far_percentiles, frame_percentiles
from skysift.llm.groups import connected_groups
from skysift.llm.language import corrected_languages, document_languages, segment_languages
from skysift.llm.leakage import leaked_items
from skysift.llm.packing import pack, token_counts, tokenizer_files
from skysift.llm.patterns import frequent_patterns
from skysift.session import materialize
from skysift.sources.tables import table


def _patterns(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "frame_sequences").select(F.col("session_key").alias("entity"), "tokens")
    return frequent_patterns(rows, 0.06, 3, 5)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _patterns(spark, d).select(F.col("pattern").alias("token_pattern"))


def p2_supports(spark: SparkSession, d: str) -> DataFrame:
    return _patterns(spark, d)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    values, p = frame_percentiles(table(spark, d, "projection_frames"))
    return far_percentiles(values, p, 60, 2.0).select(F.col("source").alias("sensor_id"), F.col("day").alias("obs_day"), "metric", "pct")


def p6_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return frame_percentiles(table(spark, d, "projection_frames"))[1].withColumnsRenamed({"source": "sensor_id", "day": "obs_day"})


def p6_exact(spark: SparkSession, d: str) -> DataFrame:
    """The exact percentiles of every sensor, day and metric, searched within their certified bounds."""
    values, p = frame_percentiles(table(spark, d, "projection_frames"))
    exact = exact_ranks(values, p.select("source", "metric", "day", "pct", "n", "least", "most", "below"))
    return exact.select(F.col("source").alias("sensor_id"), F.col("day").alias("obs_day"), "metric", "pct", F.round("value", 6).alias("value"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    mac = lambda c: canonical_mac(F.col(c))
    left = table(spark, d, "similarity_pairs").select(mac("left_source_mac").alias("a"), mac("right_source_mac").alias("b"))
    right = table(spark, d, "merge_candidates").select(mac("mac_a").alias("a"), mac("mac_b").alias("b"))
    return connected_groups(left.unionByName(right)).select(F.col("v").alias("source_mac"), F.col("group").alias("group_mac"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    """Which tokens of which document lie in which container of 2,048 tokens."""
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("item"), "text")
    return pack(token_counts(texts, *tokenizer_files())).withColumnsRenamed({"item": "doc_id", "begin": "token_begin", "end": "token_end", "size": "tokens"})


def p8_room(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens in them, the share of room left, and what must be 0: tokens missing, placed twice or beyond a container, needless splits."""
    placed = materialize(p8_packed(spark, d), "placed")
    fill = placed.groupBy("container").agg(F.sum("tokens").alias("tokens"))
    room = fill.agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.count_if(F.col("tokens") > 2048).alias("overfull"), (1 - F.sum("tokens") / (F.count("*") * 2048)).alias("room_share"))
    pieces = placed.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("tokens"), F.min("token_begin").alias("begin"), F.max("token_end").alias("end"), F.count_distinct("token_begin").alias("begins"))
    wrong = pieces.agg(F.count_if((F.col("begin") != 0) | (F.col("end") != F.col("tokens")) | (F.col("begins") != F.col("pieces"))).alias("not_once"), F.count_if(F.col("pieces") != F.ceil(F.col("tokens") / 2048)).alias("needless_splits"))
    return room.join(wrong)


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p9_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return corrected_languages(document_languages(segment_languages(table(spark, d, "documents")))).select("doc_id", "lang")


def p10_documents(spark: SparkSession, d: str) -> DataFrame:
    return document_languages(segment_languages(table(spark, d, "documents")))


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    return segment_languages(table(spark, d, "documents"))


QUERIES = {
    "p2_found": p2_found,
    "p2_supports": p2_supports,
    "p6_found": p6_found,
    "p6_percentiles": p6_percentiles,
    "p6_exact": p6_exact,
    "p7_found": p7_found,
    "p8_packed": p8_packed,
    "p8_room": p8_room,
    "p9_found": p9_found,
    "p9_evidence": p9_evidence,
    "p10_found": p10_found,
    "p10_documents": p10_documents,
    "p10_segments": p10_segments,
}

_MAC = "CASE WHEN length(regexp_replace(lower({0}), '[^0-9a-f]', '', 'g')) = 12 THEN array_to_string(list_transform(range(6), lambda i: substr(regexp_replace(lower({0}), '[^0-9a-f]', '', 'g'), CAST(2*i+1 AS BIGINT), 2)), ':') ELSE lower(trim({0})) END"

_VALUES = """
WITH f AS (SELECT dedupe_key, any_value(sensor_id) AS s, any_value(observed_at) AS t, any_value(tsft_delta_us) AS a, any_value(wall_clock_delta_ms) AS b
           FROM projection_frames WHERE sensor_id IS NOT NULL GROUP BY 1),
v AS (SELECT s, strftime(t, '%Y-%m-%d') AS d, 'tsft_delta_us' AS m, CAST(a AS DOUBLE) AS x FROM f WHERE a IS NOT NULL
      UNION ALL SELECT s, strftime(t, '%Y-%m-%d'), 'wall_clock_delta_ms', CAST(b AS DOUBLE) FROM f WHERE b IS NOT NULL),
p AS (SELECT * FROM (VALUES (50, 0.5), (95, 0.95)) AS q(pct, q)),
w AS (SELECT s, m, [quantile_cont(x, 0.5), quantile_cont(x, 0.95)] AS z FROM v GROUP BY 1, 2),
y AS (SELECT s, d, m, count(*) AS n, [quantile_cont(x, 0.5), quantile_cont(x, 0.95)] AS z FROM v GROUP BY 1, 2, 3)"""

_PERCENTILES = _VALUES + """
SELECT y.s AS sensor_id, y.d AS obs_day, y.m AS metric, CAST(p.pct AS INTEGER) AS pct
FROM y JOIN w ON y.s = w.s AND y.m = w.m, p
WHERE n >= 60 AND (y.z[CASE pct WHEN 50 THEN 1 ELSE 2 END] > 2 * w.z[CASE pct WHEN 50 THEN 1 ELSE 2 END] OR y.z[CASE pct WHEN 50 THEN 1 ELSE 2 END] < w.z[CASE pct WHEN 50 THEN 1 ELSE 2 END] / 2)"""

_EXACT = _VALUES + """
SELECT s AS sensor_id, d AS obs_day, m AS metric, CAST(pct AS INTEGER) AS pct, round(z[CASE pct WHEN 50 THEN 1 ELSE 2 END], 6) AS value FROM y, p"""

_GROUPS = f"""
WITH RECURSIVE p AS (SELECT {_MAC.format('left_source_mac')} AS a, {_MAC.format('right_source_mac')} AS b FROM similarity_pairs
                     UNION ALL SELECT {_MAC.format('mac_a')}, {_MAC.format('mac_b')} FROM merge_candidates),
e AS (SELECT DISTINCT a, b FROM (SELECT a, b FROM p UNION ALL SELECT b, a FROM p) WHERE a <> b),
r(v, g) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, r.g FROM r JOIN e ON r.v = e.a)
SELECT v AS source_mac, min(g) AS group_mac FROM r GROUP BY v"""



def _patterns_sql(columns: str) -> str:
    """Patterns of 3 to 5 tokens, a level at a time: the first place at which each sequence can end each frequent prefix."""
    keep = "count(DISTINCT e) AS support FROM {0} GROUP BY p HAVING count(DISTINCT e) >= 0.06 * (SELECT count(DISTINCT e) FROM s) - 1e-9"
    parts = [
        "s AS (SELECT row_number() OVER () AS sid, e, t FROM (SELECT DISTINCT session_key AS e, list_filter(tokens, lambda x: x <> '') AS t FROM frame_sequences WHERE session_key IS NOT NULL) WHERE len(t) > 0)",
        "w AS (SELECT sid, e, unnest(t) AS tok, generate_subscripts(t, 1) AS pos FROM s)",
        "l1 AS (SELECT sid, e, tok AS p, min(pos) AS pos FROM w GROUP BY ALL)",
        f"f1 AS (SELECT p, {keep.format('l1')})",
    ]
    for k in range(2, 6):
        parts.append(f"l{k} AS (SELECT l.sid, l.e, l.p || ' ' || w.tok AS p, min(w.pos) AS pos FROM l{k - 1} l JOIN f{k - 1} f ON f.p = l.p JOIN w ON w.sid = l.sid AND w.pos > l.pos GROUP BY ALL)")
        parts.append(f"f{k} AS (SELECT p, {keep.format(f'l{k}')})")
    found = " UNION ALL ".join(f"SELECT p AS pattern, {k} AS length, support, (SELECT count(DISTINCT e) FROM s) AS entities FROM f{k}" for k in (3, 4, 5))
    return f"WITH {', '.join(parts)} SELECT {columns} FROM ({found})"


ORACLES = {
    "p2_found": _patterns_sql("pattern AS token_pattern"),
    "p2_supports": _patterns_sql("*"),
    "p6_found": _PERCENTILES,
    "p6_exact": _EXACT,
    "p7_found": _GROUPS,
}
