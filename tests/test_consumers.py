"""Service consumers, payload resolution, retries and leases."""

import base64
import json

import pytest

import __spark_entry__ as entry
from skysift.plans.processors import PROCESSORS, in_order
from skysift.streaming.consumers import apply_backlog, device_replies, evidence, load, network_replies, probe_merge, resolved
from skysift.streaming.control import Lease, failure_class, with_retries
from skysift.streaming.ingest import decode_requests

REQUEST = "topic string, key string, value string"
BACKLOG = "stream_name string, dedupe_key string, status string, stage string, payload string, attempts long, saved_us long, next_us long"
DAY = 86_400_000_000


def requests(spark, *rows):
    return spark.createDataFrame([(t, k, v if isinstance(v, str) or v is None else json.dumps(v)) for t, k, v in rows], REQUEST)


def test_backlog(spark):
    now = 30 * DAY
    stored = spark.createDataFrame([("s", "old", "synced", "pre_publish", "{}", 2, now - 8 * DAY, 0), ("s", "kept", "synced", "pre_publish", "{}", 2, now - 6 * DAY, 0), ("s", "later", "sync_failed", "post_publish", "{}", 3, now - 5, now + 1)], BACKLOG)
    rows = [
        ("backlog.save", "a", {"dedupe_key": "new", "stream_name": "s", "payload": {"x": 1}, "failure_stage": "post_publish"}), ("backlog.save", "b", {"dedupe_key": "kept", "stream_name": "s"}),
        ("backlog.save", "c", {"dedupe_key": "", "stream_name": "s"}), ("backlog.save", "d", "{"), ("backlog.save", "e", {"dedupe_key": "x", "stream_name": "s", "failure_stage": "elsewhere"}), ("backlog.save", "f", None),
        ("backlog.synced", "g", {"dedupe_key": "later", "stream_name": "s"}), ("backlog.synced", "h", {"stream_name": "s"}), ("backlog.list", "i", {"reply_topic": "_INBOX.sensor"}), ("backlog.prune", "j", "{}"),
    ]
    after, replies, bad = apply_backlog(stored, requests(spark, *rows), now)
    assert {r.dedupe_key: (r.status, r.stage, r.attempts) for r in after.collect()} == {"kept": ("synced", "pre_publish", 2), "later": ("synced", "post_publish", 3), "new": ("pending", "post_publish", 0)}
    got = {r.key: (r.topic, json.loads(r.value)) for r in replies.collect()}
    assert got["j"] == ("backlog.replies", {"pruned": 1, "retention_days": 7})
    assert got["i"][0] == "_INBOX.sensor" and got["i"][1]["entries"] == [{"dedupe_key": "new", "stream_name": "s", "payload": '{"x":1}', "failure_stage": "post_publish", "attempt_count": 0}]
    assert sorted((r.key, json.loads(r.value)["error"]) for r in bad.collect()) == [("c", "blank dedupe_key"), ("d", "not JSON"), ("e", "invalid failure_stage"), ("f", "not JSON"), ("h", "blank dedupe_key")]
    # without a request nothing is pruned; nothing at all changes nothing
    after, replies, bad = apply_backlog(stored, requests(spark, ("other", "x", "{}")), now)
    assert sorted(r.dedupe_key for r in after.collect()) == ["kept", "later", "old"] and replies.count() == bad.count() == 0


def test_lookups_and_networks(spark):
    devices = spark.createDataFrame([("02:00:00:00:00:01", None, "one", None)], "mac_id string, username string, display_name string, hostname string")
    rows = requests(spark, ("mac.lookup", "a", {"mac": " 02:00:00:00:00:01 ", "reply_topic": "fine"}), ("mac.lookup", "b", {"mac": "02:00:00:00:00:01", "reply_topic": "../x"}), ("mac.lookup", "c", {"mac": "02:00"}), ("mac.lookup", "d", {"mac": "02:00:00:00:00:02"}), ("networks.request", "e", "{}"), ("networks.request", "f", ""))
    got = {r.key: (r.topic, r.value) for r in device_replies(rows, devices, ("fine",)).collect()}
    body = '{"device_id":"02:00:00:00:00:01","username":null,"display_name":"one","hostname":null}'
    assert got == {"a": ("fine", body), "b": ("lookup.replies", body)}
    networks = spark.createDataFrame([(2, "b", "AA", None, None, True), (1, "a", None, "l", "x", True), (3, "c", None, None, None, False)], "id long, ssid string, bssid string, location_id string, label string, enabled boolean")
    got = [(r.key, [n["ssid"] for n in json.loads(r.value)], json.loads(r.value)[1]["bssid"]) for r in network_replies(rows, networks, ()).collect()]
    assert got == [("e", ["a", "b"], "aa")]


def test_load_keeps_whole_messages_only(spark):
    batch = spark.createDataFrame([("s", "a", "1"), ("s", "b", "1"), ("s", "c", None), ("t", "a", "1")], "stream_name string, dedupe_key string, payload string")

    def rows(x):
        return x.where("payload is not null").selectExpr("dedupe_key", "explode(array(0, 1)) as row_sequence", "case when dedupe_key = 'b' then 'host' end as error")

    out = load(batch, {"sink": ("s", rows)})
    assert sorted((r.job_id, r.batch_id, r.status, r.row_count, r.error_text) for r in out["results"].collect()) == [("s", "a", "success", 2, ""), ("s", "b", "failed", 0, "missing host"), ("s", "c", "failed", 0, "no readable record"), ("t", "a", "failed", 0, "no readable record")]
    assert {r.dedupe_key for r in out["sink"].collect()} == {"a"}


def test_payloads_are_resolved(spark, tmp_path):
    (tmp_path / "box" / "in").mkdir(parents=True)
    (tmp_path / "box" / "in" / "a.json").write_text('{"f": 1}')
    (tmp_path / "secret.json").write_text('{"no": 1}')
    inline = "inline://json/" + base64.urlsafe_b64encode(b'[{"a":"\xc3\xa9"}]').decode().rstrip("=")
    refs = [inline, "outbox://in/a.json", "outbox://../secret.json", "sha256://" + "a" * 64, "sha256://" + "b" * 64, "inline://json/bnVsbA"]
    rows = [("t", 0, i, None, json.dumps({"stream_name": "s", "dedupe_key": f"k{i % 4}", "payload_ref": r, "observed_at": "2021-01-01T00:00:00Z"})) for i, r in enumerate(refs)]
    decoded = decode_requests(spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string"), ("s",))
    known = spark.createDataFrame([("a" * 64, '{"known": 1}')], "payload_sha256 string, payload string")
    out = resolved(decoded, known, str(tmp_path / "box"))
    assert {r.offset: (r.payload, r.error) for r in out.collect()} == {
        0: ('[{"a":"é"}]', None), 1: ('{"f": 1}', None), 2: (None, "payload_ref leaves the outbox"), 3: ('{"known": 1}', None), 4: (None, "payload cannot be resolved"), 5: (None, "payload cannot be resolved"),
    }
    seen = spark.createDataFrame([("s", "k1")], "stream_name string, dedupe_key string")
    assert {r.offset: r.disposition for r in evidence(out, seen, "g-v1").collect()} == {0: "processed", 1: "duplicate", 2: "dead_lettered", 3: "processed", 4: "dead_lettered", 5: "dead_lettered"}


def test_a_flush_counts_once(spark):
    clients = spark.createDataFrame([("n", "m", "b0", 5, 9, 3, "old")], "ssid string, client_mac string, known_bssid string, first_seen long, last_seen long, probe_count long, last_batch string")
    rows = spark.createDataFrame([("n", "m", None, 7, 11, 2), ("n", "m", None, 4, 8, 2), ("n2", "m", "b", 1, 1, 1)], "ssid string, client_mac string, known_bssid string, first_seen long, last_seen long, probe_count long")
    once = probe_merge(clients, rows, "new")
    for out in (once, probe_merge(once, rows, "new")):
        assert sorted(map(tuple, out.collect())) == [("n", "m", "b0", 4, 11, 7, "new"), ("n2", "m", "b", 1, 1, 1, "new")]


def test_retries():
    calls, slept = [], []

    def work(fail, kind):
        calls.append(1)
        if len(calls) <= fail:
            try:
                raise OSError(kind)
            except OSError as e:
                raise RuntimeError("wrapped") from e
        return "done"

    assert with_retries(lambda: work(2, "write conflict"), sleep=slept.append) == "done" and slept == [0.5, 1.0]
    for fail, kind in ((9, "deadlock"), (1, "syntax error")):
        calls.clear()
        with pytest.raises(RuntimeError):
            with_retries(lambda: work(fail, kind), sleep=slept.append)
        assert len(calls) == (3 if kind == "deadlock" else 1)
    assert failure_class(None) == "permanent"


def test_leases():
    lease = Lease(interval_s=20)
    assert (lease.ttl, lease.renew_after, Lease(1).ttl) == (40, 40 / 3, 30)
    assert lease.claim("a", 0) == 1 and lease.claim("b", 10) is None and lease.claim("a", 10) == 1
    assert lease.renew("a", 1, 20) and lease.claim("b", 59) is None and lease.claim("b", 61) == 2
    assert not lease.renew("a", 1, 62) and not lease.release("a", 1) and lease.release("b", 2) and lease.claim("a", 63) == 3


def test_processors_name_queries():
    queries = entry.queries()
    assert all(q in queries for _, names in PROCESSORS.values() for q in names)
    order = in_order(set(PROCESSORS))
    assert all(order.index(n) < order.index(p) for p, (needs, _) in PROCESSORS.items() for n in needs)
    with pytest.raises(ValueError, match="needs"):
        in_order({"sync-job-planner"})


def test_settings():
    from skysift.settings import settings

    fine = settings({"ingest.stream-names": ["proxy.events", "a"], "ingest.load-stream-names": "a", "kafka.groups": ["g-v1"], "processors.enabled": ["sync-scan-ingestion", "sync-job-planner"]}, {"SKYSIFT_CRON_INGEST_BATCH_SIZE": "7"})
    assert fine["cron.ingest-batch-size"] == 7 and fine["ingest.load-stream-names"] == ("a",) and fine["archive.hot-days"] == 7
    for given, message in (
        ({"nothing": 1}, "not known"), ({"kafka.locked-batch-size": 501}, "at least kafka.locked-batch-size"), ({"archive.hot-days": 0}, "at least 1"), ({"cron.scan-max-attempts": "x"}, "no number"), ({"processors.event-duplicate-distance": 2.1}, "between"),
        ({"kafka.dlq-suffix": " "}, "blank"), ({"ingest.stream-names": ["a", "a"]}, "twice.*proxy.events"), ({"ingest.load-stream-names": ["a"]}, "among"), ({"kafka.groups": ["g-v0"]}, "version"), ({"processors.enabled": ["sync-job-planner"]}, "needs"), ({"processors.enabled": ["x"]}, "not known"),
    ):
        with pytest.raises(ValueError, match=message):
            settings(given, {})
