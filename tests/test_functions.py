"""Laws of the functions, merges and guards."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skysift.functions import jsonx
from skysift.functions.frames import band, cosine_similarity, frame_token
from skysift.functions.ids import consumer_contract, name_uuid, stable_id
from skysift.functions.mac import canonical_mac
from skysift.functions.scores import ap_risk, distance_similarity, dns_score, severity, weighted_risk
from skysift.functions.text import normalized, sanitized, tokens
from skysift.operators.components import components
from skysift.operators.knn import nearest
from skysift.operators.match import null_tolerant_anti, single_match
from skysift.operators.merge import add_unless, insert_only, merge_rows
from skysift.plans.frames import behavior, sessions, timing, transitions
from skysift.plans.identity import identity_clusters
from skysift.plans.payloads import transform, wide
from skysift.streaming.control import Backpressure, StreamConfig, error_class, retry_delay_ms
from skysift.streaming.ingest import dead_letters, decode_requests, inline_payload, outbox_path


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_macs(spark):
    rows = [("02:AB:cd:00:11:22",), (" 02-ab-CD-00-11-22 ",), ("02abcd001122",), ("",), (None,), ("Not A Mac",)]
    got = [r.x for r in spark.createDataFrame(rows, "m string").select(canonical_mac(F.col("m")).alias("x")).collect()]
    assert got == ["02:ab:cd:00:11:22"] * 3 + [None, None, "not a mac"]


def test_tokens_and_bands(spark):
    t = lambda a, b: one(spark, frame_token(F.col("a"), F.col("b")), a=a, b=b)
    assert (t("data", "-"), t("-", "beacon"), t("x", "Assoc Request"), t("management", " DEAUTH"), t("control", "ack")) == ("data", "beacon", "association_request", "deauthentication", "other")
    assert [one(spark, band(F.lit(c))) for c in (1, 14, 36, 233, 234, 0)] == ["2.4GHz", "2.4GHz", "5GHz", "5GHz", "unknown", "unknown"]


def test_ids(spark):
    import hashlib
    import uuid

    assert one(spark, name_uuid(F.lit("abc"))) == str(uuid.UUID(bytes=hashlib.md5(b"abc").digest(), version=3))
    a, b = one(spark, stable_id("n", F.lit("x"))), one(spark, stable_id("m", F.lit("x")))
    h = hashlib.sha256(b"n\x1fx").hexdigest()
    assert a == f"{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}" and len(a) == 36 and a != b
    version, digest = consumer_contract(F.lit("grp-v12"), F.lit("top"))
    assert one(spark, version) == 12 and one(spark, digest) == hashlib.sha256(b"7:grp-v123:top").hexdigest()
    assert one(spark, consumer_contract(F.lit("grp-v0"), F.lit("top"))[1]) is None


def test_text(spark):
    assert one(spark, normalized(F.lit("  EXAMPLE\tWiFi  probe_request example "))) == "example wifi probe_request example"
    assert one(spark, normalized(F.lit("ﬁle Ａ"))) == "file a"
    assert one(spark, tokens(F.lit("example wifi probe_request example"))) == ["example", "wifi", "probe_request", "example"]
    clean = one(spark, sanitized(F.lit("x://u:secretpw@h password = abc Bearer q.w\x00e \n y")))
    assert "secretpw" not in clean and "abc" not in clean and "q.w" not in clean


def test_scores(spark):
    s = dns_score(F.lit(4), F.lit(396), F.lit(2))
    assert one(spark, s) == 800 and one(spark, severity(s)) == "high"
    assert one(spark, dns_score(F.lit(0), F.lit(0), F.lit(0))) == 0
    risk = {k: one(spark, c) for k, c in ap_risk(*map(F.lit, (4.0, 3.0, 2.0, 1.0, 0.5))).items()}
    assert risk == pytest.approx({"signal_risk": 0.45, "identity_risk": 0.35, "behaviour_risk": 0.10, "composite_risk": 0.90})
    with pytest.raises(Exception, match="not finite"):
        one(spark, ap_risk(F.lit(float("nan")), *map(F.lit, (0.0,) * 4))["composite_risk"])
    assert one(spark, distance_similarity(F.lit(0.05))) == pytest.approx(0.95)
    with pytest.raises(Exception, match="invalid cosine"):
        one(spark, distance_similarity(F.lit(2.5)))
    df = spark.createDataFrame([(200.0, 0.5), (80.0, 0.75)], "s double, w double")
    assert df.select(weighted_risk(F.col("s"), F.col("w")).alias("x")).first().x == 100
    cos = lambda a, b: one(spark, cosine_similarity(F.array(*map(F.lit, a)), F.array(*map(F.lit, b))))
    assert cos((1.0, 0.0), (1.0, 0.0)) == 1 and cos((0.0, 0.0), (1.0, 0.0)) == 0 and cos((1.0,), (1.0, 2.0)) is None


GUARDS = {
    "numeric": ('{"i": 2147483647, "n": -2147483648, "o": 2147483648, "f": 4.0, "s": " 42 ", "e": "1e2", "big": "99999999999999999999999999999999999999999"}', {"i": 2147483647, "n": -2147483648, "o": None, "f": None, "s": 42, "e": None, "big": None, "absent": None}),
    "wrong": ('{"i": null, "n": {}, "o": [], "f": true, "s": "42\\n", "e": "", "big": "null"}', {"i": None, "n": None, "o": None, "f": None, "s": None, "e": None, "big": None}),
}


@pytest.mark.parametrize("case", GUARDS)
def test_integer_guard(spark, case):
    payload, want = GUARDS[case]
    df = spark.createDataFrame([(payload,)], "p string").select(F.parse_json("p").alias("v"))
    got = df.select(*(jsonx.integer(F.col("v"), f"$.{k}").alias(k) for k in want)).first().asDict()
    assert got == want


def test_other_guards(spark):
    v = F.parse_json(F.lit('{"t": "x", "e": "", "n": 1, "b": true, "s": "FALSE", "two": 2, "d": "1e308", "inf": "1e309", "x": 0.6, "a": [1], "z": null, "long": "abcdef"}'))
    assert one(spark, jsonx.text(v, 5, "$.t")) == "x" and one(spark, jsonx.text(v, 5, "$.e", "$.t")) == "x" and one(spark, jsonx.text(v, 5, "$.e", keep_empty=True)) == ""
    assert one(spark, jsonx.text(v, 5, "$.long")) is None and one(spark, jsonx.text(v, 5, "$.n")) is None and one(spark, jsonx.text(v, 5, "$.z")) is None
    assert [one(spark, jsonx.flag(v, f"$.{k}")) for k in ("b", "s", "n", "two", "t", "z")] == [1, 0, 1, None, None, None]
    assert [one(spark, jsonx.double(v, f"$.{k}")) for k in ("x", "d", "inf", "n", "b")] == [0.6, 1e308, None, 1.0, None]
    assert one(spark, jsonx.array_text(v, "$.a")) == "[1]" and one(spark, jsonx.array_text(v, "$.t")) is None


def test_wide_projection_defaults(spark):
    row = wide(spark.createDataFrame([("k", '{"ssid": "null", "signal_dbm": "-42", "retry": "1", "schema_version": null, "mac": {"bssid": "AA"}}'), ("bad", "{")], "dedupe_key string, payload string")).orderBy("dedupe_key").collect()
    assert (row[1].schema_version, row[1].ssid, row[1].signal_dbm, row[1].noise_dbm, row[1].retry, row[1].raw_len, row[1].mixed_encryption, row[1].bssid, row[1].destination_bssid) == (1, "null", -42, None, 1, 0, None, "aa", "aa")
    assert (row[0].schema_version, row[0].ssid, row[0].protected) == (1, None, 0)


def rows_of(spark, stream, payload, kind):
    df = spark.createDataFrame([(stream, "k", json.dumps(payload) if not isinstance(payload, str) else payload)], "stream_name string, dedupe_key string, payload string")
    return [r.asDict() for r in transform(df, kind).collect()]


def test_transforms(spark):
    base = {"sensor_id": "s", "location_id": "l", "detected_at": "2026-01-01T00:00:00Z", "interface": "w"}
    p = {"type": "block", "host": "h", "time": "2026-01-01T00:00:00+02:00", "bytes_up": "100", "bytes_down": 200, "blocked": True, "risk_score": 1000000}
    e = rows_of(spark, "proxy.events", [p, {"type": "x"}], "proxy_events")
    assert (e[0]["row_sequence"], e[0]["bytes_up"], e[0]["identity_source"], e[0]["error"]) == (1, 100, "unknown", None) and e[1]["error"] == "host,event_time"
    b = rows_of(spark, "proxy.events", p, "blocked_events")
    assert (len(b), b[0]["blocked_bytes"], b[0]["risk_score"], b[0]["verdict"]) == (1, 300, 999999.9999, "BLOCKED")
    a = rows_of(spark, "proxy.payload_audit", {"host": "h", "observed_at": "2026-01-01T00:00:00Z", "direction": "down"}, "proxy_payload_audit")[0]
    assert a["direction"] == "DOWN" and len(a["correlation_id"]) == 36
    assert rows_of(spark, "wireless.rogue_ap", base | {"channel": 6, "bssid": "b", "reasons": ["bssid_spoofing"]}, "rogue_ap")[0]["ssid_impersonation"] == 1
    assert rows_of(spark, "wireless.alert.deauth_flood", base | {"frame_count": 9, "window_secs": 1}, "deauth_flood")[0]["deauth_count"] == 9
    assert rows_of(spark, "wireless.alert.signal_anomaly", base | {"source_mac": "m", "channel": 1, "baseline_dbm": -50, "observed_dbm": -80, "dbm_delta": -30, "configured_delta": 10}, "signal_anomaly")[0]["dbm_delta"] == 30
    assert rows_of(spark, "wireless.alert.pmf_attack", base | {"source_mac": "m", "attack_tag": "t"}, "pmf_attack")[0]["target_mac"] == "m"
    seq = {"first_event_at": "2026-01-01T00:00:00Z", "last_event_at": "2026-01-01T00:00:00Z", "attack_chain": "no array", "ssid": ""}
    s = rows_of(spark, "wireless.attack_sequence", base | seq, "attack_sequence")[0]
    assert s["ssid"] == "" and s["attack_chain"] is None and s["error"] is None
    h = rows_of(spark, "wifi.alert.handshake", base | {"bssid": "b", "client_mac": "c", "pmkid": "secret"}, "handshake")[0]
    assert len(h["pmkid_sha256"]) == 64 and "secret" not in str(h)
    inv = {"sensor_id": "P", "location_id": "L", "observed_at": "2026-01-01T00:00:00Z", "clients": [{"sensor_id": "child", "source_mac": "m", "first_seen": "2026-01-01T00:00:00Z", "last_seen": "2026-01-01T00:00:00Z", "last_signal_dbm": -3}, None]}
    i = rows_of(spark, "wireless.client.inventory", inv, "client_inventory")
    assert i[0]["sensor_id"] == "P" and i[0]["signal_dbm"] == -3 and i[0]["error"] is None
    assert len(rows_of(spark, "wireless.probe.flush", {"probes": [{}, {}]}, "probe_requests")) == 2
    assert rows_of(spark, "wireless.bandwidth.unknown", {}, "wireless_bandwidth") == [] and rows_of(spark, "proxy.events", "{", "proxy_events") == []


def test_merge_rules(spark):
    old = spark.createDataFrame([("a", 5, 1, "b1", None), ("b", 7, 2, "b1", "x")], "k string, lo int, n int, mark string, t string")
    new = spark.createDataFrame([("a", 3, 10, "b2", "y"), ("c", 1, 4, "b2", None), (None, 9, 9, "b2", None)], old.schema)
    rules = {"lo": "least", "n": add_unless("mark"), "t": "coalesce_new"}
    once = merge_rows(old, new, ["k"], rules)
    got = sorted((tuple(r) for r in once.collect()), key=str)
    assert got == sorted([("a", 3, 11, "b2", "y"), ("b", 7, 2, "b1", "x"), ("c", 1, 4, "b2", None), (None, 9, 9, "b2", None)], key=str)
    assert sorted((tuple(r) for r in merge_rows(once, new, ["k"], rules).collect()), key=str) == got  # a repeated batch changes nothing
    assert sorted(r.k for r in insert_only(old, new.where("k is not null"), ["k"]).collect()) == ["a", "b", "c"]


def test_components_and_clusters(spark):
    e = spark.createDataFrame([("b", "c"), ("a", "b"), ("z", "y"), ("q", "q"), (None, "a")], "a string, b string")
    assert sorted(map(tuple, components(e).collect())) == [("a", "a"), ("b", "a"), ("c", "a"), ("y", "y"), ("z", "y")]
    chain = spark.range(200).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("a"), F.lpad((F.col("id") + 1).cast("string"), 3, "0").alias("b"))
    assert {r.root for r in components(chain).collect()} == {"000"}
    _, sums = identity_clusters(spark.createDataFrame([("aa", "bb", 0.95), ("aa", "bb", 0.97), ("bb", "cc", 0.91)], "a string, b string, confidence double"))
    assert [(r["size"], r.confidence) for r in sums.collect()] == [(3, 0.91)]


def test_nearest(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [1.0, 0.0]), (5, None), (6, []), (7, [1.0, 2.0, 3.0]), (8, [0.0, 0.0])], "id long, vec array<double>")
    got = [(r.query_id, r.id, r["rank"]) for r in nearest(v, v.where("id = 1"), 2).collect()]
    assert sorted(got) == [(1, 2, 2), (1, 4, 1)]


def test_null_tolerant_matches(spark):
    rows = spark.createDataFrame([("l1", "b1"), ("l2", "b2"), ("l3", None), (None, None), ("l2", "b2")], "location_id string, bssid string")
    pats = spark.createDataFrame([("l1", None, "x"), (None, "b9", "y"), ("l3", "b3", "z"), ("l2", None, "u"), ("l2", "b2", "v")], "location_id string, bssid string, ssid string")
    on = rows.columns
    assert sorted(tuple(r) for r in null_tolerant_anti(rows, pats.where("ssid < 'u' or ssid > 'v'"), on).collect() if r.location_id) == [("l2", "b2"), ("l2", "b2"), ("l3", None)]
    assert null_tolerant_anti(rows, spark.createDataFrame([(None, None)], rows.schema), on).count() == 0
    assert null_tolerant_anti(rows, pats.where("false"), on).count() == 5
    assert [tuple(r) for r in single_match(rows, pats, on, "ssid").collect()] == [("l1", "b1", "x")]
    every = pats.unionByName(spark.createDataFrame([(None, None, "w")], pats.schema))
    assert sorted((r.location_id or "-", r.ssid) for r in single_match(rows, every, on, "ssid").collect()) == [("-", "w"), ("l3", "w")]
    assert single_match(rows, pats.where("false"), on, "ssid").count() == 0


FRAME = "dedupe_key string, source_mac string, observed_at timestamp_ntz, location_id string, sensor_id string, frame_type string, frame_subtype string, signal_dbm int, retry boolean, protected boolean, bssid string, adjacent_mac_hint string, tsft_delta_us long, wall_clock_delta_ms long, session_key string, window_start timestamp"


def test_frame_projections(spark):
    h, m = datetime(2026, 1, 1, 10), datetime(2026, 1, 1, 10, 1)
    rows = [("k2", "m", m, "l", None, "management", "deauth", -70, True, False, "b", None, 30, 6, "s", h), ("k1", "m", h, None, "s1", "management", "beacon", -50, False, True, "b", None, 10, 2, "s", h)]
    df = spark.createDataFrame(rows, FRAME)
    b = behavior(df).first()
    assert (b.event_count, b.avg_signal, b.retry_count, b.location_id, b.sensor_id) == (2, -60.0, 1, "l", "s1")
    t = timing(df).first()
    assert (t.tsft_p50, t.tsft_jitter, t.wall_p50) == (20.0, 10.0, 4.0)
    assert sessions(df.drop("window_start")).first().tokens == ["beacon", "deauthentication"]
    assert transitions(df).first().probability == 1.0


def test_control():
    b = Backpressure(10)
    assert [b.update(n) for n in (9, 10, 8, 6, 5, 9)] == [False, True, True, True, False, False]
    delays = {retry_delay_ms(a, "k") for a in range(20)}
    assert all(800 <= x <= 9600 for x in delays) and retry_delay_ms(3, "k") == retry_delay_ms(3, "k")
    assert error_class("40001", "") == "retryable" and error_class(None, "Deadlock found") == "retryable" and error_class("42000", "syntax") == "permanent"
    assert error_class("hyt00") == error_class(code=-9007) == error_class(message="region unavailable") == "retryable" and error_class("HYT00X") == error_class(message="connection refused") == "permanent"
    assert StreamConfig((" a ", ""), group="x-v2").validate().streams == ("a",)
    with pytest.raises(ValueError, match="version"):
        StreamConfig(("a",), group="x-v0").validate()


def test_requests_and_payloads(spark):
    ok = {"stream_name": "s", "dedupe_key": "k", "payload_ref": "r", "observed_at": "2026-06-01T12:00:00Z"}
    cases = [(ok, None), ({**ok, "observed_at": "2026-06-01"}, "observed_at is no instant"), ({**ok, "stream_name": "t"}, "stream is not configured"), ({**ok, "dedupe_key": ""}, "dedupe_key is missing"), ({**ok, "dedupe_key": "x" * 256}, "dedupe_key is too long")]
    df = spark.createDataFrame([("t", 0, i, None, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [("t", 0, 99, "m", "{")], "topic string, partition int, offset long, key string, value string")
    assert {r.key for r in dead_letters(decode_requests(df, ("s",)), "g-v1").collect()} == {"0:1", "0:2", "0:3", "0:4", "m"}
    got = {r.offset: r.error for r in decode_requests(df, ("s",)).collect()}
    assert got == {i: e for i, (_, e) in enumerate(cases)} | {99: "not JSON"}
    pay = lambda r: one(spark, inline_payload(F.lit(r)))
    assert pay("inline://json/eyJhIjoxfQ") == '{"a":1}' and pay("inline://json/bnVsbA") is None and pay("inline://json/e30=") == "{}" and pay("file://x") is None
    assert outbox_path("/r", "outbox://a/b.json") == "/r/a/b.json"
    for bad in ("outbox://../x", "outbox:///etc", "outbox://a/../../b", "x://a"):
        with pytest.raises(ValueError):
            outbox_path("/r", bad)
