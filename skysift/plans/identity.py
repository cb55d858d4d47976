"""Similarity, identity clusters, graph, shadow alerts and risk."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.frames import cosine_similarity
from skysift.functions.ids import stable_id
from skysift.functions.mac import canonical_mac, epoch_us
from skysift.functions.scores import clamp, distance_similarity, weighted_risk
from skysift.operators.components import components
from skysift.operators.knn import nearest
from skysift.plans.frames import FRAMES_SQL, deliveries, frames, stable_sql
from skysift.plans.problems import canon_sql
from skysift.plans.registry import NOW, Registry
from skysift.session import materialize
from skysift.sources.tables import table

query = Registry()
TS = f"timestamp_ntz'{NOW}'"


def _neighbours(spark: SparkSession, d: str, k: int) -> DataFrame:
    """Each vector whose id is divisible by 50 against all vectors."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return nearest(v, v.where("id % 50 = 0"), k)


_KNN = """k AS (SELECT q.vec_id AS query_id, v.vec_id AS id, 1 - list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) AS distance,
 row_number() OVER (PARTITION BY q.vec_id ORDER BY 1 - list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), v.vec_id) AS rank FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id)"""


@query("q16_knn_topk", f"WITH {_KNN} SELECT query_id, id, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 8")
def knn_topk(spark: SparkSession, d: str) -> DataFrame:
    return _neighbours(spark, d, 8).select("query_id", "id", F.round("distance", 6).alias("distance"), "rank")


@query("q16b_cosine_expression", """
SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine_expression(spark: SparkSession, d: str) -> DataFrame:
    """Similarity of each vector to the next one, by the column expression."""
    e = table(spark, d, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(cosine_similarity(F.col("embedding"), F.col("other")), 6).alias("similarity"))


def stored_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Similarity pairs in one orientation, null sides and self pairs left out."""
    a, b = canonical_mac(F.col("left_source_mac")), canonical_mac(F.col("right_source_mac"))
    p = table(spark, d, "similarity_pairs").select(a.alias("l"), b.alias("r"), "embedding_kind", "cosine_distance", "computed_at").where("l is not null and r is not null and l <> r")
    return p.select(F.least("l", "r").alias("mac_a"), F.greatest("l", "r").alias("mac_b"), "embedding_kind", "cosine_distance", "computed_at")


_PAIRS = f"""p AS (SELECT least(l, r) AS mac_a, greatest(l, r) AS mac_b, embedding_kind, cosine_distance, computed_at FROM (SELECT {canon_sql('left_source_mac')} AS l, {canon_sql('right_source_mac')} AS r, * FROM similarity_pairs) WHERE l IS NOT NULL AND r IS NOT NULL AND l <> r)"""


@query("q17_similarity_pairs", f"""
WITH {_PAIRS}, m AS (SELECT mac_a, mac_b, embedding_kind, min(cosine_distance) AS d FROM p GROUP BY 1, 2, 3)
SELECT {stable_sql('similarity-pair', 'embedding_kind', 'mac_a', 'mac_b')} AS pair_id, mac_a, mac_b, embedding_kind, d AS cosine_distance, greatest(-1, least(1, 1 - d)) AS cosine_similarity
FROM m WHERE NOT EXISTS (SELECT 1 FROM merge_candidates c WHERE least({canon_sql('c.mac_a')}, {canon_sql('c.mac_b')}) = m.mac_a AND greatest({canon_sql('c.mac_a')}, {canon_sql('c.mac_b')}) = m.mac_b)""")
def similarity_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with their least distance, without those already candidates in either orientation."""
    m = stored_pairs(spark, d).groupBy("mac_a", "mac_b", "embedding_kind").agg(F.min("cosine_distance").alias("cosine_distance"))
    a, b = canonical_mac(F.col("mac_a")), canonical_mac(F.col("mac_b"))
    known = table(spark, d, "merge_candidates").select(F.least(a, b).alias("mac_a"), F.greatest(a, b).alias("mac_b"))
    fresh = m.join(known, ["mac_a", "mac_b"], "left_anti")
    return fresh.select(stable_id("similarity-pair", F.col("embedding_kind"), F.col("mac_a"), F.col("mac_b")).alias("pair_id"), "mac_a", "mac_b", "embedding_kind", "cosine_distance", distance_similarity(F.col("cosine_distance")).alias("cosine_similarity"))


@query("q17b_merge_candidates", f"""
WITH {_PAIRS} SELECT {stable_sql('merge-candidate', 'mac_a', 'mac_b')} AS candidate_id, mac_a, mac_b, max(1 - cosine_distance) AS confidence, epoch_us(max(computed_at) + INTERVAL 30 DAY) AS expires_us
FROM p WHERE cosine_distance <= CASE embedding_kind WHEN 'behavior' THEN 0.12 WHEN 'sequence' THEN 0.10 ELSE 0.05 END GROUP BY mac_a, mac_b""")
def merge_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Close pairs become candidates: one per unordered pair, the greatest confidence kept."""
    limit = F.when(F.col("embedding_kind") == "behavior", 0.12).when(F.col("embedding_kind") == "sequence", 0.10).otherwise(0.05)
    g = stored_pairs(spark, d).where(F.col("cosine_distance") <= limit).groupBy("mac_a", "mac_b").agg(F.max(1 - F.col("cosine_distance")).alias("confidence"), (F.max("computed_at") + F.expr("INTERVAL 30 DAYS")).alias("expires"))
    return g.select(stable_id("merge-candidate", F.col("mac_a"), F.col("mac_b")).alias("candidate_id"), "mac_a", "mac_b", "confidence", epoch_us(F.col("expires")).alias("expires_us"))


def approved_edges(spark: SparkSession, d: str) -> DataFrame:
    """Merged candidates as edges: finite, non-negative confidence, no blanks, no self links."""
    a, b = canonical_mac(F.col("mac_a")), canonical_mac(F.col("mac_b"))
    c = table(spark, d, "merge_candidates").where("status = 'merged'").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "confidence")
    return c.where("a is not null and b is not null and a <> b and confidence >= 0 and not isnan(confidence) and confidence < double('infinity')").select("a", "b", clamp(F.col("confidence"), 0.0, 1.0).alias("confidence"))


def identity_clusters(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: node, root) and (clusters: root, size, confidence)."""
    members = components(edges.select("a", "b"))
    pairs = edges.groupBy("a", "b").agg(F.max("confidence").alias("confidence"))
    confidence = pairs.join(members.withColumnRenamed("node", "a"), "a").groupBy("root").agg(F.min("confidence").alias("confidence"))
    return members, members.groupBy("root").agg(F.count("*").alias("size")).join(confidence, "root")


_EDGES = f"""e AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b, least(greatest(confidence, 0), 1) AS confidence FROM (SELECT {canon_sql('mac_a')} AS a, {canon_sql('mac_b')} AS b, confidence FROM merge_candidates WHERE status = 'merged') WHERE a <> b AND confidence >= 0 AND isfinite(confidence)),
x(a, b) AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(v, g) AS (SELECT a, a FROM x UNION SELECT x.b, r.g FROM r JOIN x ON r.v = x.a),
m AS (SELECT v AS node, min(g) AS root FROM r GROUP BY v)"""


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stable id of each root's members, which come in order: one running digest is kept, however many there are."""
    root, digest, ids = None, None, []
    mark = lambda h: f"{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}"
    for b in batches:
        for r, node in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if r != root:
                if digest is not None:
                    ids.append((root, mark(digest.hexdigest())))
                root, digest = r, hashlib.sha256(b"identity-cluster")
            digest.update(b"\x1f" + node.encode())
    if digest is not None:
        ids.append((root, mark(digest.hexdigest())))
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*ids)], ["root", "cluster_id"])


def cluster_ids(members: DataFrame) -> DataFrame:
    """(root, cluster_id) by the sorted members of each cluster, without listing any cluster."""
    return members.select("root", "node").repartition("root").sortWithinPartitions("root", "node").mapInArrow(_chained, "root string, cluster_id string")


@query("q18_identity_clusters", f"""
WITH RECURSIVE {_EDGES}, c AS (SELECT m.root, min(y.confidence) AS confidence FROM (SELECT a, b, max(confidence) AS confidence FROM e GROUP BY 1, 2) y JOIN m ON m.node = y.a GROUP BY 1)
SELECT {stable_sql('identity-cluster', "string_agg(m.node, chr(31) ORDER BY m.node)")} AS cluster_id, m.root AS first_member, count(*) AS cluster_size, any_value(c.confidence) AS confidence FROM m JOIN c ON c.root = m.root GROUP BY m.root""")
def clusters(spark: SparkSession, d: str) -> DataFrame:
    members, sums = identity_clusters(approved_edges(spark, d))
    return sums.join(cluster_ids(members), "root").select("cluster_id", F.col("root").alias("first_member"), F.col("size").alias("cluster_size"), "confidence")


def known_clusters(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(clusters: root, cluster_id, cluster_name, size, confidence, first, last) and (members: root, mac, first, last).

    Members are devices, that is addresses seen in frames; clusters without any are left out.
    """
    members, sums = identity_clusters(approved_edges(spark, d))
    devices = deliveries(spark, d).groupBy(F.col("source_mac").alias("node")).agg(F.min("observed_at").alias("first"), F.max("observed_at").alias("last"))
    known = materialize(members.join(devices, "node").select("root", F.col("node").alias("mac"), "first", "last"), "members")
    seen = known.groupBy("root").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    whole = sums.join(cluster_ids(members), "root").join(seen, "root").withColumn("cluster_name", F.concat(F.lit("identity-"), F.left("cluster_id", F.lit(8))))
    return whole, known


_CLUSTERS = f"""{_EDGES}, {FRAMES_SQL}, dv AS (SELECT source_mac AS node, min(observed_at) AS first, max(observed_at) AS last FROM f GROUP BY 1),
cc AS (SELECT m.root, min(y.confidence) AS confidence FROM (SELECT a, b, max(confidence) AS confidence FROM e GROUP BY 1, 2) y JOIN m ON m.node = y.a GROUP BY 1),
ci AS (SELECT root, {stable_sql('identity-cluster', "string_agg(node, chr(31) ORDER BY node)")} AS cluster_id, count(*) AS size, to_json(list(node ORDER BY node)) AS macs FROM m GROUP BY root),
km AS (SELECT m.root, m.node AS mac, dv.first, dv.last FROM m JOIN dv ON dv.node = m.node),
kc AS (SELECT ci.*, cc.confidence, 'identity-' || left(cluster_id, 8) AS cluster_name, min(km.first) AS first, max(km.last) AS last FROM ci JOIN cc ON cc.root = ci.root JOIN km ON km.root = ci.root GROUP BY ALL)"""


@query("q18c_cluster_rows", f"WITH RECURSIVE {_CLUSTERS} SELECT cluster_id, cluster_name, size AS cluster_size, epoch_us(first) AS first_us, epoch_us(last) AS last_us, 'active' AS status FROM kc")
def cluster_rows(spark: SparkSession, d: str) -> DataFrame:
    whole, _ = known_clusters(spark, d)
    return whole.select("cluster_id", "cluster_name", F.col("size").alias("cluster_size"), epoch_us(F.col("first")).alias("first_us"), epoch_us(F.col("last")).alias("last_us"), F.lit("active").alias("status"))


@query("q18d_cluster_members", f"""WITH RECURSIVE {_CLUSTERS} SELECT kc.cluster_id, km.mac, kc.confidence, '{{"source":"approved_merge_decision"}}' AS evidence, epoch_us(km.first) AS first_us, epoch_us(km.last) AS last_us FROM km JOIN kc ON kc.root = km.root""")
def cluster_members(spark: SparkSession, d: str) -> DataFrame:
    whole, known = known_clusters(spark, d)
    evidence = F.to_json(F.struct(F.lit("approved_merge_decision").alias("source")))
    return known.join(whole.select("root", "cluster_id", "confidence"), "root").select("cluster_id", "mac", "confidence", evidence.alias("evidence"), epoch_us(F.col("first")).alias("first_us"), epoch_us(F.col("last")).alias("last_us"))


@query("q18e_inventory_devices", f"""WITH RECURSIVE {_CLUSTERS} SELECT km.mac, kc.cluster_id AS similarity_cluster_id, kc.confidence AS dedup_confidence, kc.size AS known_macs, true AS active, false AS registered, '[]' AS tags, epoch_us(km.first) AS first_us, epoch_us(km.last) AS last_us FROM km JOIN kc ON kc.root = km.root""")
def inventory_devices(spark: SparkSession, d: str) -> DataFrame:
    """Inventory of the devices of clusters; known_macs is how many addresses the cluster has, which q18d lists as rows."""
    whole, known = known_clusters(spark, d)
    return known.join(whole.select("root", "cluster_id", "confidence", "size"), "root").select(
        "mac", F.col("cluster_id").alias("similarity_cluster_id"), F.col("confidence").alias("dedup_confidence"), F.col("size").alias("known_macs"), F.lit(True).alias("active"), F.lit(False).alias("registered"), F.lit("[]").alias("tags"),
        epoch_us(F.col("first")).alias("first_us"), epoch_us(F.col("last")).alias("last_us"),
    )


@query("q18b_cluster_seen", f"""
WITH RECURSIVE {_EDGES}, {FRAMES_SQL} SELECT m.root, epoch_us(min(observed_at)) AS first_us, epoch_us(max(observed_at)) AS last_us, count(DISTINCT m.node) AS known_members FROM m JOIN f ON f.source_mac = m.node GROUP BY 1""")
def cluster_seen(spark: SparkSession, d: str) -> DataFrame:
    """When members known as devices were first and last seen; clusters without any are left out."""
    devices = deliveries(spark, d).groupBy("source_mac").agg(F.min("observed_at").alias("first"), F.max("observed_at").alias("last"))
    members = components(approved_edges(spark, d).select("a", "b"))
    g = members.join(devices.withColumnRenamed("source_mac", "node"), "node").groupBy("root")
    return g.agg(epoch_us(F.min("first")).alias("first_us"), epoch_us(F.max("last")).alias("last_us"), F.count("*").alias("known_members"))


@query("q19_graph_nodes", f"""
WITH RECURSIVE {_CLUSTERS} SELECT 'device:' || source_mac AS node_id, 'device' AS kind, CAST(NULL AS VARCHAR) AS label, CAST(NULL AS VARCHAR) AS location_id, CAST(NULL AS VARCHAR) AS sensor_id, CAST(epoch_us(max(observed_at)) AS DOUBLE) AS observed_us FROM f GROUP BY source_mac
UNION ALL SELECT 'ap:' || f.bssid, 'access_point', max(n.ssid), max(f.location_id), max(f.sensor_id), epoch_us(max(observed_at)) FROM f LEFT JOIN (SELECT bssid, max(ssid) AS ssid FROM wireless_authorized_networks WHERE bssid IS NOT NULL GROUP BY 1) n ON n.bssid = f.bssid WHERE f.bssid IS NOT NULL GROUP BY f.bssid
UNION ALL SELECT 'identity:' || cluster_id, 'identity_cluster', cluster_name, NULL, NULL, epoch_us(last) FROM kc""")
def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Devices, access points (with the name of their authorised network, if any) and active identity clusters."""
    f = deliveries(spark, d, "sensor_id", "location_id", "bssid")
    none = lambda c: F.lit(None).cast("string").alias(c)
    seen = epoch_us(F.max("observed_at")).cast("double").alias("observed_us")
    device = f.groupBy("source_mac").agg(seen).select(F.concat(F.lit("device:"), "source_mac").alias("node_id"), F.lit("device").alias("kind"), none("label"), none("location_id"), none("sensor_id"), "observed_us")
    names = table(spark, d, "wireless_authorized_networks").where("bssid is not null").groupBy("bssid").agg(F.max("ssid").alias("label"))
    ap = f.where("bssid is not null").groupBy("bssid").agg(F.max("location_id").alias("location_id"), F.max("sensor_id").alias("sensor_id"), seen).join(names, "bssid", "left")
    ap = ap.select(F.concat(F.lit("ap:"), "bssid").alias("node_id"), F.lit("access_point").alias("kind"), "label", "location_id", "sensor_id", "observed_us")
    whole, _ = known_clusters(spark, d)
    cluster = whole.select(F.concat(F.lit("identity:"), "cluster_id").alias("node_id"), F.lit("identity_cluster").alias("kind"), F.col("cluster_name").alias("label"), none("location_id"), none("sensor_id"), epoch_us(F.col("last")).cast("double").alias("observed_us"))
    return device.unionByName(ap).unionByName(cluster)


@query("q20_graph_edges", f"""
WITH RECURSIVE {_CLUSTERS} SELECT 'observed:' || source_mac || ':' || bssid AS edge_id, 'device:' || source_mac AS from_id, 'ap:' || bssid AS to_id, 'observed_at' AS kind, CAST(count(*) AS DOUBLE) AS weight, epoch_us(max(observed_at)) AS observed_us FROM f WHERE bssid IS NOT NULL GROUP BY source_mac, bssid
UNION ALL SELECT 'identity-member:' || cluster_id || ':' || mac, 'device:' || mac, 'identity:' || cluster_id, 'identity_member', kc.confidence, epoch_us(km.last) FROM km JOIN kc ON kc.root = km.root""")
def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    """Observations of access points by devices, and devices' membership of identities with its confidence."""
    mac, ap = F.col("source_mac"), F.col("bssid")
    seen = frames(spark, d, "bssid").where("bssid is not null").groupBy("source_mac", "bssid").agg(F.count("*").cast("double").alias("weight"), epoch_us(F.max("observed_at")).alias("observed_us"))
    observed = seen.select(F.concat_ws(":", F.lit("observed"), mac, ap).alias("edge_id"), F.concat(F.lit("device:"), mac).alias("from_id"), F.concat(F.lit("ap:"), ap).alias("to_id"), F.lit("observed_at").alias("kind"), "weight", "observed_us")
    whole, known = known_clusters(spark, d)
    inside = known.join(whole.select("root", "cluster_id", "confidence"), "root").select(
        F.concat_ws(":", F.lit("identity-member"), "cluster_id", "mac").alias("edge_id"), F.concat(F.lit("device:"), "mac").alias("from_id"), F.concat(F.lit("identity:"), "cluster_id").alias("to_id"), F.lit("identity_member").alias("kind"),
        F.col("confidence").alias("weight"), epoch_us(F.col("last")).alias("observed_us"),
    )
    return observed.unionByName(inside)


@query("q49_union_outliers", f"""
WITH {_PAIRS} SELECT mac, max(cosine_distance) AS outlier_score, count(*) AS pairs FROM (SELECT mac_a AS mac, cosine_distance FROM p WHERE cosine_distance > 0.15 UNION ALL SELECT mac_b, cosine_distance FROM p WHERE cosine_distance > 0.15) GROUP BY 1""")
def union_outliers(spark: SparkSession, d: str) -> DataFrame:
    """Both sides of a pair by one explode instead of reading the pairs twice."""
    sides = stored_pairs(spark, d).where("cosine_distance > 0.15").select(F.explode(F.array("mac_a", "mac_b")).alias("mac"), "cosine_distance")
    return sides.groupBy("mac").agg(F.max("cosine_distance").alias("outlier_score"), F.count("*").alias("pairs"))


@query("q49b_changed_tokens", """
SELECT DISTINCT t FROM (SELECT unnest(tokens) AS t FROM frame_sequences WHERE window_start < TIMESTAMP '2021-01-10' UNION SELECT unnest(tokens) FROM frame_sequences WHERE window_start >= TIMESTAMP '2021-01-20') WHERE t IS NOT NULL""")
def changed_tokens(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "frame_sequences")
    part = lambda cond: s.where(cond).select(F.explode("tokens").alias("t")).where("t is not null")
    return part("window_start < timestamp_ntz'2021-01-10'").union(part("window_start >= timestamp_ntz'2021-01-20'")).distinct()


@query("q50_weighted_risk", f"""
WITH {_PAIRS} SELECT mac_a, round(least(100, greatest(0, sum(least(100, greatest(0, cosine_distance * 150 - 5)) * greatest(0.6 - cosine_distance, 0)))), 6) AS risk FROM p GROUP BY 1""")
def weighted(spark: SparkSession, d: str) -> DataFrame:
    """Scores of an address' pairs, bounded, weighted and summed."""
    score, weight = F.col("cosine_distance") * 150 - 5, 0.6 - F.col("cosine_distance")
    return stored_pairs(spark, d).groupBy("mac_a").agg(F.round(weighted_risk(score, weight), 6).alias("risk"))
