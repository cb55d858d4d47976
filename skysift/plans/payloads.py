"""Wide guarded projection of audit payloads, its split into frame tables, and row transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions import jsonx
from skysift.functions.ids import name_uuid, sha256
from skysift.functions.text import search_text
from skysift.plans.registry import Registry
from skysift.session import materialize
from skysift.sources.tables import table

query = Registry()

# Column, kind, limit and alias paths of the wide projection.
WIDE = (
    ("sensor_id", "text", 64, "$.sensor_id"),
    ("location_id", "text", 128, "$.location_id"),
    ("username", "text", 255, "$.username"),
    ("event_type", "text", 64, "$.event_type", "$.type"),
    ("schema_version", "int", 1, "$.schema_version"),
    ("frame_type", "text", 32, "$.frame_type", "$.mac.frame_type"),
    ("frame_subtype", "text", 64, "$.frame_subtype", "$.mac.frame_subtype"),
    ("source_mac", "lower", 17, "$.source_mac", "$.mac.source_mac"),
    ("transmitter_mac", "lower", 17, "$.transmitter_mac", "$.mac.transmitter_mac"),
    ("receiver_mac", "lower", 17, "$.receiver_mac", "$.mac.receiver_mac"),
    ("bssid", "lower", 17, "$.bssid", "$.mac.bssid"),
    ("destination_bssid", "lower", 17, "$.destination_bssid", "$.destination_mac", "$.mac.destination_mac", "$.mac.bssid"),
    ("ssid", "present", 256, "$.ssid"),
    ("signal_dbm", "int", None, "$.signal_dbm", "$.rf.signal_dbm"),
    ("noise_dbm", "int", None, "$.noise_dbm", "$.rf.noise_dbm"),
    ("frequency_mhz", "int", None, "$.frequency_mhz", "$.rf.frequency_mhz"),
    ("channel_flags", "int", None, "$.channel_flags", "$.rf.channel_flags.raw"),
    ("data_rate_kbps", "int", None, "$.data_rate_kbps", "$.rf.data_rate_kbps"),
    ("antenna_id", "int", None, "$.antenna_id", "$.rf.antenna_id"),
    ("tsft", "long", None, "$.tsft", "$.rf.tsft"),
    ("fragment_number", "int", None, "$.fragment_number", "$.mac.fragment_number"),
    ("channel_number", "int", None, "$.channel_number", "$.channel", "$.rf.channel_number"),
    ("signal_status", "text", 64, "$.signal_status", "$.rf.signal_status"),
    ("adjacent_mac_hint", "lower", 512, "$.adjacent_mac_hint", "$.mac.adjacent_mac_hint"),
    ("qos_tid", "int", None, "$.qos_tid", "$.qos.tid"),
    ("qos_eosp", "flag", None, "$.qos_eosp", "$.qos.eosp"),
    ("qos_ack_policy", "int", None, "$.qos_ack_policy", "$.qos.ack_policy"),
    ("qos_ack_policy_label", "text", 64, "$.qos_ack_policy_label", "$.qos.ack_policy_label"),
    ("qos_amsdu", "flag", None, "$.qos_amsdu", "$.qos.amsdu"),
    ("llc_oui", "text", 16, "$.llc_oui", "$.llc_snap.oui"),
    ("ethertype", "int", None, "$.ethertype", "$.llc_snap.ethertype"),
    ("ethertype_name", "text", 64, "$.ethertype_name", "$.llc_snap.ethertype_name"),
    ("src_ip", "text", 45, "$.src_ip", "$.network.src_ip"),
    ("dst_ip", "text", 45, "$.dst_ip", "$.network.dst_ip"),
    ("ip_ttl", "int", None, "$.ip_ttl", "$.network.ttl"),
    ("ip_protocol", "int", None, "$.ip_protocol", "$.network.protocol"),
    ("ip_protocol_name", "text", 64, "$.ip_protocol_name", "$.network.protocol_name"),
    ("src_port", "int", None, "$.src_port", "$.transport.src_port"),
    ("dst_port", "int", None, "$.dst_port", "$.transport.dst_port"),
    ("transport_protocol", "text", 32, "$.transport_protocol", "$.transport.protocol"),
    ("transport_length", "int", None, "$.transport_length", "$.transport.length"),
    ("transport_checksum", "int", None, "$.transport_checksum", "$.transport.checksum"),
    ("app_protocol", "text", 64, "$.app_protocol", "$.application.protocol"),
    ("ssdp_message_type", "text", 64, "$.ssdp_message_type", "$.application.ssdp.message_type"),
    ("ssdp_st", "text", 512, "$.ssdp_st", "$.application.ssdp.st"),
    ("ssdp_mx", "text", 64, "$.ssdp_mx", "$.application.ssdp.mx"),
    ("ssdp_usn", "text", 512, "$.ssdp_usn", "$.application.ssdp.usn"),
    ("dhcp_requested_ip", "text", 45, "$.dhcp_requested_ip", "$.application.dhcp.requested_ip"),
    ("dhcp_hostname", "text", 253, "$.dhcp_hostname", "$.application.dhcp.hostname"),
    ("dhcp_vendor_class", "text", 255, "$.dhcp_vendor_class", "$.application.dhcp.vendor_class"),
    ("dns_query_name", "text", 253, "$.dns_query_name", "$.application.dns.query_names[0]"),
    ("mdns_name", "text", 253, "$.mdns_name", "$.application.mdns.query_names[0]"),
    ("session_key", "text", 255, "$.session_key", "$.correlation.session_key"),
    ("retransmit_key", "text", 255, "$.retransmit_key", "$.correlation.retransmit_key"),
    ("frame_fingerprint", "text", 255, "$.frame_fingerprint", "$.correlation.frame_fingerprint"),
    ("payload_visibility", "text", 64, "$.payload_visibility", "$.correlation.payload_visibility"),
    ("tsft_delta_us", "long", None, "$.tsft_delta_us", "$.correlation.tsft_delta_us"),
    ("wall_clock_delta_ms", "long", None, "$.wall_clock_delta_ms", "$.correlation.wall_clock_delta_ms"),
    ("large_frame", "flag", 0, "$.large_frame", "$.anomalies.large_frame"),
    ("mixed_encryption", "flag", None, "$.mixed_encryption", "$.anomalies.mixed_encryption"),
    ("dedupe_or_replay_suspect", "flag", 0, "$.dedupe_or_replay_suspect", "$.anomalies.dedupe_or_replay_suspect"),
    ("raw_len", "int", 0, "$.raw_len", "$.rf.raw_len"),
    ("frame_control_flags", "int", 0, "$.frame_control_flags"),
    ("more_data", "flag", 0, "$.more_data", "$.mac.more_data"),
    ("retry", "flag", 0, "$.retry", "$.mac.retry"),
    ("power_save", "flag", 0, "$.power_save", "$.mac.power_save"),
    ("protected", "flag", 0, "$.protected", "$.mac.protected"),
    ("security_flags", "int", 0, "$.security_flags"),
    ("risk_score", "double", None, "$.risk_score"),
    ("identity_source", "text", 64, "$.identity_source"),
    ("tags", "array", None, "$.tags"),
    ("wps_device_name", "text", 255, "$.wps_device_name"),
    ("wps_manufacturer", "text", 255, "$.wps_manufacturer"),
    ("wps_model_name", "text", 255, "$.wps_model_name"),
    ("device_fingerprint", "text", 255, "$.device_fingerprint"),
    ("handshake_captured", "flag", 0, "$.handshake_captured"),
)
# The columns that make the search text, in order.
SEARCHED = ("sensor_id", "source_mac", "bssid", "destination_bssid", "ssid", "wps_device_name", "wps_manufacturer", "wps_model_name", "device_fingerprint", "app_protocol", "src_ip", "dst_ip", "username")

# The seven frame tables and their columns besides dedupe_key.
FRAME_TABLES = {
    "wireless_frames": ("observed_at", "stream_name", "sensor_id", "location_id", "event_type", "schema_version", "frame_type", "frame_subtype", "source_mac", "bssid", "destination_bssid", "ssid", "channel_number", "bssid_oui"),
    "wireless_frame_radio": ("signal_dbm", "noise_dbm", "frequency_mhz", "channel_flags", "data_rate_kbps", "antenna_id", "tsft", "tsft_delta_us", "wall_clock_delta_ms", "signal_status"),
    "wireless_frame_qos": ("qos_tid", "qos_eosp", "qos_ack_policy", "qos_ack_policy_label", "qos_amsdu", "fragment_number", "more_data", "retry", "power_save"),
    "wireless_frame_network": ("llc_oui", "ethertype", "ethertype_name", "src_ip", "dst_ip", "ip_ttl", "ip_protocol", "ip_protocol_name", "src_port", "dst_port", "transport_protocol", "transport_length", "transport_checksum", "app_protocol"),
    "wireless_frame_app_signals": ("ssdp_message_type", "ssdp_st", "ssdp_mx", "ssdp_usn", "dhcp_requested_ip", "dhcp_hostname", "dhcp_vendor_class", "dns_query_name", "mdns_name"),
    "wireless_frame_identity": ("username", "identity_source", "session_key", "retransmit_key", "frame_fingerprint", "payload_visibility", "adjacent_mac_hint", "wps_device_name", "wps_manufacturer", "wps_model_name", "device_fingerprint", "handshake_captured", "normalized_text"),
    "wireless_frame_security": ("protected", "security_flags", "large_frame", "mixed_encryption", "dedupe_or_replay_suspect", "raw_len", "frame_control_flags", "risk_score", "tags"),
}


def _guarded(v: Column, kind: str, limit: int | None, paths: tuple[str, ...]) -> Column:
    if kind in ("text", "lower", "present"):
        c = jsonx.text(v, limit, *paths, keep_empty=kind == "present")
        return F.lower(c) if kind == "lower" else c
    c = {"int": jsonx.integer, "long": jsonx.integer, "double": jsonx.double, "flag": jsonx.flag, "array": jsonx.array_text}[kind](v, *paths, **({"most": jsonx.LONG_MAX} if kind == "long" else {}))
    return c if limit is None else F.coalesce(c, F.lit(limit))


def wide(events: DataFrame, only: set[str] | None = None) -> DataFrame:
    """The 76 guarded columns, and the search text, of ``events(dedupe_key, payload, ...)``.

    With ``only``, just those columns (and what the search text needs, if it is among them).

    The payload is parsed once; payloads that are no JSON give nulls and defaults.
    """
    parsed = events.withColumn("v", F.try_parse_json("payload"))
    text = only is None or "wireless_search_text" in only
    wanted = lambda name: only is None or name in only or (text and name in SEARCHED)
    columns = [_guarded(F.col("v"), kind, limit, tuple(paths)).alias(name) for name, kind, limit, *paths in WIDE if wanted(name)]
    flat = parsed.select(*(c for c in events.columns if c != "payload"), *columns)
    if not text:
        return flat
    return flat.withColumn("wireless_search_text", search_text(*(F.col(c) for c in SEARCHED)))


def latest_payload(payload: str = "payload", updated: str = "updated_at") -> Column:
    """Aggregate: the latest readable copy of a payload, unwrapped if it is JSON text inside a JSON string.

    Objects and arrays are readable; of copies of equal age the greatest text counts. Plain
    payloads are parsed once here, to see whether they can be.
    """
    inner = F.try_variant_get(F.try_parse_json(payload), "$", "string")
    text = F.when(F.ltrim(payload).startswith('"'), inner).otherwise(F.col(payload))
    fine = F.left(F.ltrim(text), F.lit(1)).isin("{", "[") & F.try_parse_json(text).isNotNull()
    return F.max_by(text, F.when(fine, F.struct(F.col(updated), text)))


def audit_events(spark: SparkSession, d: str) -> DataFrame:
    """Audit messages with a payload, each once, in their latest readable copy (else null)."""
    rows = table(spark, d, "sync_events").where("stream_name = 'wireless.audit' and payload is not null")
    return rows.groupBy("dedupe_key").agg(F.min("stream_name").alias("stream_name"), F.min("observed_at").alias("observed_at"), latest_payload().alias("payload"))


def frame_tables(events: DataFrame) -> dict[str, DataFrame]:
    """The vertical split of wide rows into seven tables on dedupe_key."""
    return {name: frame_table(events, name) for name in FRAME_TABLES}


def frame_table(events: DataFrame, name: str) -> DataFrame:
    """One of the seven frame tables; only its own columns are extracted."""
    made = {
        "bssid_oui": F.upper(F.replace(F.left(F.coalesce("bssid", "source_mac"), F.lit(8)), F.lit(":"), F.lit(""))),
        "normalized_text": F.col("wireless_search_text"),
        "tags": F.coalesce("tags", F.lit("[]")),
    }
    needs = {"bssid_oui": {"bssid", "source_mac"}, "normalized_text": {"wireless_search_text"}}
    columns = FRAME_TABLES[name]
    rows = wide(events, set().union(*(needs.get(c, {c}) for c in columns)))
    return rows.select("dedupe_key", *(made[c].alias(c) if c in made else F.col(c) for c in columns))


# SQL twins of the guards, for the checks.


def _sql_each(paths: list[str], one) -> str:
    return "coalesce(" + ", ".join(one(f"json_type(payload, '{p}')", f"json_extract_string(payload, '{p}')") for p in paths) + ", NULL)"


def sql_guard(kind: str, limit: int | None, paths: list[str]) -> str:
    if kind in ("text", "lower", "present"):
        s = "{s}" if kind == "present" else "nullif({s}, '')"
        c = _sql_each(paths, lambda t, x: f"CASE WHEN {t} = 'VARCHAR' AND length({x}) <= {limit} THEN {s.format(s=x)} END")
        return f"lower({c})" if kind == "lower" else c
    if kind in ("int", "long"):
        most = jsonx.LONG_MAX if kind == "long" else jsonx.INT_MAX
        c = _sql_each(paths, lambda t, x: f"CASE WHEN {t} IN ('BIGINT', 'UBIGINT', 'VARCHAR') AND regexp_full_match(trim({x}), '[+-]?[0-9]+') AND TRY_CAST(trim({x}) AS HUGEINT) BETWEEN -{most} - 1 AND {most} THEN TRY_CAST(trim({x}) AS BIGINT) END")
    elif kind == "flag":
        c = _sql_each(paths, lambda t, x: f"CASE WHEN {t} IN ('BOOLEAN', 'BIGINT', 'UBIGINT', 'VARCHAR') THEN CASE lower(trim({x})) WHEN 'true' THEN 1 WHEN '1' THEN 1 WHEN 'false' THEN 0 WHEN '0' THEN 0 END END")
    elif kind == "double":
        c = _sql_each(paths, lambda t, x: f"CASE WHEN {t} IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') AND regexp_full_match(trim({x}), '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(trim({x}) AS DOUBLE) END")
    else:
        return " ".join(["coalesce(", ", ".join(f"CASE WHEN json_type(payload, '{p}') = 'ARRAY' THEN CAST(len(json_extract(payload, '{p}[*]')) AS VARCHAR) END" for p in paths), ", NULL)"])
    return c if limit is None else f"coalesce({c}, {limit})"


_READABLE = "SELECT *, CASE WHEN json_valid(payload) THEN CASE WHEN ltrim(payload) LIKE '\"%' THEN json_extract_string(payload, '$') ELSE payload END END AS p FROM sync_events"
_LATEST = "arg_max(p, (updated_at, p)) FILTER (WHERE json_valid(p) AND left(ltrim(p), 1) IN ('{', '['))"
_AUDIT = f"e AS (SELECT dedupe_key, min(stream_name) AS stream_name, min(observed_at) AS observed_at, coalesce({_LATEST}, '{{}}') AS payload FROM ({_READABLE}) WHERE stream_name = 'wireless.audit' AND payload IS NOT NULL GROUP BY 1)"
_GUARDED = {name: sql_guard(kind, limit, paths) for name, kind, limit, *paths in WIDE}
_NUMBERS = [n for n, kind, *_ in WIDE if kind in ("int", "long", "flag", "double")]


def _casts(names) -> str:
    return ", ".join(f"CAST({_GUARDED[n]} AS DOUBLE) AS {n}" if n in _NUMBERS else f"{_GUARDED[n]} AS {n}" for n in names)


@query("q28_json_guards", f"WITH {_AUDIT} SELECT dedupe_key, {_casts([n for n, kind, *_ in WIDE])} FROM e")
def json_guards(spark: SparkSession, d: str) -> DataFrame:
    """All guarded columns of the wide projection; numbers as double, so that nulls compare, arrays as their size."""
    w = wide(audit_events(spark, d), {n for n, *_ in WIDE})
    size = F.expr("cast(json_array_length(tags) as varchar(20))")
    return w.select("dedupe_key", *(size.alias(n) if kind == "array" else F.col(n).cast("double").alias(n) if n in _NUMBERS else F.col(n) for n, kind, *_ in WIDE))


@query("q29_json_projection", f"""
WITH {_AUDIT}, w AS (SELECT dedupe_key, {_casts([n for n, kind, *_ in WIDE])} FROM e)
SELECT dedupe_key, {', '.join(n for n, kind, *_ in WIDE if kind != 'array')}, CAST(tags AS DOUBLE) AS tag_count,
 nullif(lower(concat_ws(' ', {', '.join(SEARCHED)})), '') AS wireless_search_text FROM w""")
def json_projection(spark: SparkSession, d: str) -> DataFrame:
    w = wide(audit_events(spark, d))
    count = F.expr("cast(json_array_length(tags) as double)").alias("tag_count")
    return w.select("dedupe_key", *((F.col(n).cast("double").alias(n) if n in _NUMBERS else F.col(n)) for n, kind, *_ in WIDE if kind != "array"), count, "wireless_search_text")


def _table_query(name: str):
    columns = FRAME_TABLES[name]
    special = {"observed_at": "epoch_us(observed_at)", "stream_name": "stream_name", "bssid_oui": f"upper(replace(left(coalesce({_GUARDED['bssid']}, {_GUARDED['source_mac']}), 8), ':', ''))", "normalized_text": f"nullif(lower(concat_ws(' ', {', '.join(_GUARDED[s] for s in SEARCHED)})), '')", "tags": f"CAST(coalesce({_GUARDED['tags']}, '0') AS DOUBLE)"}
    parts = ", ".join(f"{special[c]} AS {c}" if c in special else _casts([c]) for c in columns)

    @query(f"q09_{name}", f"WITH {_AUDIT} SELECT dedupe_key, {parts} FROM e")
    def run(spark: SparkSession, d: str) -> DataFrame:
        t = frame_table(audit_events(spark, d), name)
        shown = {"observed_at": F.unix_micros(F.col("observed_at").cast("timestamp")), "tags": F.expr("cast(json_array_length(tags) as double)")}
        return t.select("dedupe_key", *((shown[c].alias(c) if c in shown else F.col(c).cast("double").alias(c) if c in _NUMBERS else F.col(c)) for c in columns))


for _name in FRAME_TABLES:
    _table_query(_name)


@query("q08_projection_star", f"""
WITH {_AUDIT} SELECT dedupe_key, {_casts(['source_mac', 'frame_type', 'frame_subtype', 'signal_dbm', 'retry', 'protected', 'bssid', 'app_protocol', 'adjacent_mac_hint', 'tsft_delta_us', 'wall_clock_delta_ms', 'session_key'])} FROM e""")
def projection_star(spark: SparkSession, d: str) -> DataFrame:
    """The projection frame rebuilt by five left joins on one key.

    The payloads are parsed once, into one written table of the columns wanted; the joined
    tables are narrow scans of it.
    """
    wanted = ("source_mac", "frame_type", "frame_subtype", "bssid", "signal_dbm", "tsft_delta_us", "wall_clock_delta_ms", "retry", "app_protocol", "protected", "adjacent_mac_hint", "session_key")
    w = materialize(wide(audit_events(spark, d), set(wanted)), "wide")
    star = w.select("dedupe_key", *wanted[:4])
    for name in ("radio", "qos", "network", "security", "identity"):
        star = star.join(w.select("dedupe_key", *(c for c in FRAME_TABLES[f"wireless_frame_{name}"] if c in wanted)), "dedupe_key", "left")
    return star.select("dedupe_key", *((F.col(c).cast("double").alias(c) if c in _NUMBERS else F.col(c)) for c in star.columns if c != "dedupe_key"))


# Row transforms: stream name, required columns, and every column's expression.

ROUTES = {
    "proxy.events": "proxy_events", "proxy.payload_audit": "proxy_payload_audit", "wireless.audit": "wireless_audit_frames", "audit.wireless.bandwidth": "wireless_bandwidth",
    "wireless.rogue_ap": "rogue_ap", "wireless.alert.rogue_ap": "rogue_ap", "wireless.deauth_flood": "deauth_flood", "wireless.alert.deauth_flood": "deauth_flood",
    "wireless.signal_anomaly": "signal_anomaly", "wireless.alert.signal_anomaly": "signal_anomaly", "wireless.pmf_attack": "pmf_attack", "wireless.alert.pmf_attack": "pmf_attack",
    "wireless.client_inventory": "client_inventory", "wireless.client.inventory": "client_inventory", "wireless.probe_requests": "probe_requests", "wireless.probe.flush": "probe_requests",
    "wireless.attack_sequence": "attack_sequence", "wireless.alert.attack_sequence": "attack_sequence", "wireless.sequence": "sequence_alert", "wireless.alert.sequence": "sequence_alert", "wireless.sequence_alert": "sequence_alert",
    "wifi.alert.handshake": "handshake", "wireless.alert.handshake": "handshake", "wireless.handshake": "handshake",
}


def target(stream: Column) -> Column:
    """The sink of a stream by any of its names; null for unknown streams."""
    return F.create_map(*(F.lit(x) for p in ROUTES.items() for x in p))[stream]


def payload_rows(events: DataFrame, kind: str) -> DataFrame:
    """One row ``v variant, row_sequence`` for each record of each payload.

    Records are the elements of a top-level array or the object itself; of client inventories
    the clients, of probe flushes the probes (objects with one such member). Parent members
    that clients inherit stand in the column ``parent``. Payloads that are no JSON give none.
    """
    parsed = events.withColumn("parent", F.try_parse_json("payload")).where("parent is not null")
    inner = {"client_inventory": "$.clients", "probe_requests": "$.probes"}.get(kind)
    kind_of = F.schema_of_variant(F.col("parent"))
    whole = F.when(kind_of.startswith("ARRAY"), F.try_variant_get("parent", "$", "array<variant>")).when(kind_of.startswith("OBJECT"), F.array("parent"))
    rows = F.coalesce(F.try_variant_get("parent", inner, "array<variant>"), whole) if inner else whole
    return parsed.select("*", F.posexplode(rows).alias("row_sequence", "v"))


class SparkReader:
    """Members of a record as typed columns, read leniently; the first path that gives a value counts."""

    def __init__(self, v: Column, parent: Column) -> None:
        self.v, self.parent = v, parent

    @staticmethod
    def first(*cells: Column) -> Column:
        return F.coalesce(*cells)

    @staticmethod
    def value(x: int | str) -> Column:
        return F.lit(x)

    def text(self, *paths: str) -> Column:
        """A string that is not empty."""
        return F.coalesce(*(jsonx.lenient_text(self.v, f"$.{p}") for p in paths))

    def present(self, *paths: str) -> Column:
        """A string, which may be empty."""
        return F.coalesce(*(jsonx.present_text(self.v, f"$.{p}") for p in paths))

    def long(self, *paths: str) -> Column:
        return F.coalesce(*(jsonx.lenient_long(self.v, f"$.{p}") for p in paths))

    def double(self, *paths: str) -> Column:
        return F.coalesce(*(jsonx.lenient_double(self.v, f"$.{p}") for p in paths))

    def flag(self, path: str) -> Column:
        return jsonx.bool_flag(self.v, f"$.{path}")

    def time(self, *paths: str) -> Column:
        return F.coalesce(*(jsonx.lenient_time(self.v, f"$.{p}") for p in paths))

    def day(self, path: str) -> Column:
        """The date of an instant in its own offset, as text."""
        return F.when(self.time(path).isNotNull(), F.left(jsonx.present_text(self.v, f"$.{path}"), F.lit(10)))

    def array(self, path: str) -> Column:
        return jsonx.array_text(self.v, f"$.{path}")

    def inherited(self, *paths: str) -> Column:
        """A string of the enclosing record, which may be empty."""
        return F.coalesce(*(jsonx.present_text(self.parent, f"$.{p}") for p in paths))

    def inherited_time(self, *paths: str) -> Column:
        return jsonx.instant(self.inherited(*paths))

    def holds(self, path: str, *words: str) -> Column:
        """1 if an array of strings holds one of the words, else 0."""
        return F.coalesce(F.arrays_overlap(F.try_variant_get(self.v, f"$.{path}", "array<string>"), F.array(*map(F.lit, words))), F.lit(False)).cast("int")

    def either(self, a: Column, b: Column) -> Column:
        return F.greatest(a, b)

    def bounded(self, c: Column, most: float) -> Column:
        return F.when(c.isNotNull(), F.greatest(F.lit(-most), F.least(F.lit(most), c)))

    def upper(self, c: Column) -> Column:
        return F.upper(c)

    def magnitude(self, c: Column) -> Column:
        return F.abs(c)

    def digest(self, c: Column) -> Column:
        return sha256(c)

    def record_id(self) -> Column:
        return name_uuid(F.to_json(self.v))


class SqlReader:
    """The same cells as SQL texts over ``payload`` and ``parent``, for the checks."""

    @staticmethod
    def first(*cells: str) -> str:
        return f"coalesce({', '.join(cells)})" if len(cells) > 1 else cells[0]

    @staticmethod
    def value(x: int | str) -> str:
        return f"'{x}'" if isinstance(x, str) else str(x)

    def present(self, *paths: str, of: str = "payload") -> str:
        return self.first(*(f"CASE WHEN json_type({of}, '$.{p}') = 'VARCHAR' THEN json_extract_string({of}, '$.{p}') END" for p in paths))

    def text(self, *paths: str) -> str:
        return self.first(*(f"nullif({self.present(p)}, '')" for p in paths))

    def long(self, *paths: str) -> str:
        return self.first(*(f"CASE WHEN json_type(payload, '$.{p}') IN ('BIGINT', 'UBIGINT', 'DOUBLE') OR (json_type(payload, '$.{p}') = 'VARCHAR' AND regexp_full_match(json_extract_string(payload, '$.{p}'), '[+-]?[0-9]+')) THEN CASE WHEN TRY_CAST(json_extract_string(payload, '$.{p}') AS DOUBLE) % 1 = 0 THEN TRY_CAST(json_extract_string(payload, '$.{p}') AS BIGINT) END END" for p in paths))

    def double(self, *paths: str) -> str:
        return self.first(*(f"CASE WHEN json_type(payload, '$.{p}') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') THEN TRY_CAST(json_extract_string(payload, '$.{p}') AS DOUBLE) END" for p in paths))

    def flag(self, path: str) -> str:
        v = f"json_extract_string(payload, '$.{path}')"
        return f"CASE WHEN json_type(payload, '$.{path}') = 'BOOLEAN' AND {v} = 'true' THEN 1 WHEN json_type(payload, '$.{path}') IN ('BIGINT', 'UBIGINT') AND {v} <> '0' THEN 1 ELSE 0 END"

    @staticmethod
    def _instant(text: str) -> str:
        return f"CASE WHEN regexp_full_match({text}, '.*T.*(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)') THEN TRY_CAST({text} AS TIMESTAMPTZ) END"

    def time(self, *paths: str) -> str:
        return self.first(*(self._instant(self.present(p)) for p in paths))

    def day(self, path: str) -> str:
        return f"CASE WHEN {self.time(path)} IS NOT NULL THEN left({self.present(path)}, 10) END"

    def array(self, path: str) -> str:
        return f"CASE WHEN json_type(payload, '$.{path}') = 'ARRAY' THEN json_extract(payload, '$.{path}') END"

    def inherited(self, *paths: str) -> str:
        return self.present(*paths, of="parent")

    def inherited_time(self, *paths: str) -> str:
        return self._instant(self.inherited(*paths))

    def holds(self, path: str, *words: str) -> str:
        return f"CASE WHEN list_has_any(CAST(json_extract_string(payload, '$.{path}[*]') AS VARCHAR[]), {list(words)}) THEN 1 ELSE 0 END"

    def either(self, a: str, b: str) -> str:
        return f"greatest({a}, {b})"

    def bounded(self, c: str, most: float) -> str:
        return f"CASE WHEN {c} IS NOT NULL THEN greatest(-{most}, least({most}, {c})) END"

    def upper(self, c: str) -> str:
        return f"upper({c})"

    def magnitude(self, c: str) -> str:
        return f"abs({c})"

    def digest(self, c: str) -> str:
        return f"sha256({c})"

    def record_id(self) -> str:
        return "NULL"


def columns_of(kind: str, r: SparkReader | SqlReader) -> dict[str, Column | str]:
    """A sink's columns; see REQUIRED for those that must not be null."""
    s, p, n, x, f, t, a = r.text, r.present, r.long, r.double, r.flag, r.time, r.array
    z = lambda c, d=0: r.first(c, r.value(d))
    same = lambda one, *names: {c: one(c) for c in names}
    place = {"sensor_id": p("sensor_id"), "location_id": p("location_id")}
    if kind == "proxy_events":
        return {
            "type": p("type"), "host": p("host"), "event_time": t("time"), **same(s, "peer_ip", "wg_pubkey", "device_id"), "identity_source": z(s("identity_source"), "unknown"),
            **same(s, "peer_hostname", "client_ua"), "bytes_up": z(n("bytes_up")), "bytes_down": z(n("bytes_down")), "status_code": n("status_code"), "blocked": f("blocked"), **same(s, "obfuscation_profile", "correlation_id", "parent_event_id"),
            **same(n, "event_sequence", "duration_ms"), "reason": s("reason"),
        }
    if kind == "blocked_events":
        given = n("blocked_bytes", "metrics.blocked_bytes", "metrics.total_blocked_bytes_approx")
        return {
            "host": p("host"), "event_time": t("time"), "given_bytes": given, "bytes_up": z(n("bytes_up")), "bytes_down": z(n("bytes_down")), "frequency_hz": x("frequency_hz", "metrics.frequency_hz"),
            "risk_score": r.bounded(x("risk_score", "metrics.risk_score"), 999999.9999), "category": s("category"), "verdict": z(s("verdict"), "BLOCKED"), "tarpit_held_ms": z(n("tarpit_held_ms")), "iat_ms": n("iat_ms", "metrics.iat_ms"),
            "consecutive_blocks": n("consecutive_blocks", "metrics.consecutive_blocks", "attempt_count", "metrics.attempt_count"), "last_verdict": s("last_verdict"), "tls_ver": s("fingerprint.tls_ver"), "alpn": s("fingerprint.alpn"),
            "ja3_lite": s("fingerprint.ja3_lite"), "resolved_ip": s("resolved_ip"), "asn_org": s("asn_org"), "blocked": f("blocked"),
        }
    if kind == "proxy_payload_audit":
        return {
            "correlation_id": r.first(s("correlation_id"), r.record_id()), "host": p("host"), "direction": r.upper(z(s("direction"), "UP")), "captured_at": t("observed_at"), "byte_offset": z(n("byte_offset")),
            **same(s, "payload_object_key", "content_type"), "http_method": s("method"), "http_status": n("http_status", "status_code"), "http_path": s("path"), **same(f, "is_encrypted", "truncated"), **same(s, "peer_ip", "notes"),
        }
    if kind == "wireless_audit_frames":
        flags = {c: f(path) for c, path in (("is_retry", "retry"), ("is_more_data", "more_data"), ("is_power_save", "power_save"), ("is_protected", "protected"), ("is_to_ds", "to_ds"), ("is_from_ds", "from_ds"), ("is_handshake", "handshake_captured"))}
        return {
            "event_type": p("event_type"), "observed_at": t("observed_at"), **place, "interface": p("interface"), "channel": n("channel"), "frame_type": s("frame_type"), "frame_subtype": p("frame_subtype"),
            **same(s, "bssid", "source_mac", "destination_mac", "transmitter_mac", "receiver_mac", "destination_bssid"), "ssid": p("ssid"), **same(n, "signal_dbm", "sequence_number", "raw_len"), **flags,
            "security_flags": z(n("security_flags")), **same(s, "device_id", "username"), "identity_source": z(s("identity_source"), "unknown"), **same(a, "tags", "anomaly_reasons"), "reg_domain": s("reg_domain"),
        }
    if kind == "wireless_bandwidth":
        return {
            "schema_version": z(n("schema_version"), 1), **same(t, "window_start", "window_end"), "window_day": r.day("window_start"), **place, "interface": p("interface"), "channel": n("channel"), **same(p, "source_mac", "destination_bssid"),
            "ssid": s("ssid"), **same(n, "bytes", "frame_count"), **{c: z(n(c)) for c in ("retry_count", "more_data_count", "power_save_count")}, "strongest_signal_dbm": n("strongest_signal_dbm"),
            **{f"hist_{c}": z(n(f"frame_size_histogram.{path}")) for c, path in (("under_100", "under_100"), ("100_500", "range_100_500"), ("500_1000", "range_500_1000"), ("1000_1500", "range_1000_1500"))},
            "inter_arrival_p50_ms": n("inter_arrival_p50_ms"), **same(f, "external_bssid", "threshold_exceeded", "window_is_partial"), "wall_clock_delta_ms": n("wall_clock_delta_ms"), "published_at": t("published_at"),
        }
    if kind == "client_inventory":
        return {
            "sensor_id": r.first(r.inherited("sensor_id"), p("sensor_id")), "location_id": r.first(r.inherited("location_id"), p("location_id")), "snapshot_at": r.first(r.inherited_time("snapshot_at", "observed_at"), t("snapshot_at")),
            "client_mac": p("client_mac", "source_mac"), **same(s, "bssid", "ssid", "device_id", "username", "identity_source"), **same(t, "last_seen", "first_seen"), "signal_dbm": n("signal_dbm", "last_signal_dbm"), "is_authorized": f("is_authorized"),
        }
    if kind == "probe_requests":
        return {**same(p, "client_mac", "ssid"), "known_bssid": s("known_bssid"), **same(t, "first_seen", "last_seen"), "probe_count": n("probe_count")}
    detected = {"detected_at": t("detected_at", "observed_at"), **place}
    span, why = same(t, "first_event_at", "last_event_at"), same(a, "factor_breakdown", "explanation")
    return {
        "rogue_ap": lambda: {**detected, "interface": p("interface"), "channel": n("channel"), "rogue_bssid": p("rogue_bssid", "bssid"), "ssid": s("ssid"), "signal_dbm": n("signal_dbm"), "ssid_impersonation": r.either(f("ssid_impersonation"), r.holds("reasons", "ssid_impersonation", "bssid_spoofing"))},
        "deauth_flood": lambda: {
            **detected, "interface": p("interface"), "channel": z(n("channel")), "attacker_mac": s("attacker_mac", "source_mac"), "target_bssid": s("target_bssid", "bssid"), "ssid": s("target_ssid", "ssid"),
            "deauth_count": n("deauth_count", "frame_count"), "window_secs": n("window_secs"), "threshold": z(n("threshold")), "signal_dbm": n("signal_dbm"),
        },
        "signal_anomaly": lambda: {**detected, "source_mac": p("source_mac"), **same(s, "bssid", "ssid"), **same(n, "channel", "baseline_dbm", "observed_dbm"), "dbm_delta": r.magnitude(n("dbm_delta")), "configured_delta": n("configured_delta")},
        "pmf_attack": lambda: {**detected, "target_mac": p("target_mac", "source_mac"), "target_bssid": s("target_bssid", "bssid"), "ssid": s("ssid"), "channel": n("channel"), "attack_tag": p("attack_tag"), "reconnect_window_ms": n("reconnect_window_ms")},
        "attack_sequence": lambda: {**detected, "ssid": p("ssid"), "attack_chain": a("attack_chain"), **span, **why},
        "sequence_alert": lambda: {**detected, "session_key": p("session_key"), **same(s, "source_mac", "bssid"), **same(p, "ssid", "attack_tag"), "sequence": a("sequence"), **span, **why},
        "handshake": lambda: {**detected, **same(p, "interface", "bssid", "client_mac"), "signal_dbm": n("signal_dbm"), "pmkid_sha256": r.digest(s("pmkid"))},
    }[kind]()


REQUIRED = {
    "proxy_events": ("type", "host", "event_time"), "blocked_events": ("host", "event_time"), "proxy_payload_audit": ("host", "captured_at"),
    "wireless_audit_frames": ("event_type", "observed_at", "sensor_id", "location_id", "interface", "channel", "frame_subtype", "raw_len"),
    "wireless_bandwidth": ("window_start", "window_end", "sensor_id", "location_id", "interface", "channel", "source_mac", "destination_bssid", "bytes", "frame_count"),
    "rogue_ap": ("detected_at", "sensor_id", "location_id", "interface", "channel", "rogue_bssid"), "deauth_flood": ("detected_at", "sensor_id", "location_id", "interface", "deauth_count", "window_secs"),
    "signal_anomaly": ("detected_at", "sensor_id", "location_id", "source_mac", "channel", "baseline_dbm", "observed_dbm", "dbm_delta", "configured_delta"),
    "pmf_attack": ("detected_at", "sensor_id", "location_id", "target_mac", "attack_tag"), "client_inventory": ("sensor_id", "location_id", "snapshot_at", "client_mac", "last_seen", "first_seen"),
    "probe_requests": ("client_mac", "ssid", "first_seen", "last_seen", "probe_count"), "attack_sequence": ("detected_at", "sensor_id", "location_id", "first_event_at", "last_event_at"),
    "sequence_alert": ("detected_at", "sensor_id", "location_id", "session_key", "attack_tag", "first_event_at", "last_event_at"), "handshake": ("detected_at", "sensor_id", "location_id", "interface", "bssid", "client_mac"),
}


def transform(events: DataFrame, kind: str) -> DataFrame:
    """Typed rows of one sink from ``events(stream_name, dedupe_key, payload)``.

    Adds row_sequence (from 1 for proxy events, else from 0) and error: the names of required
    columns that are missing, or null. Rows with an error belong to the dead letters.
    """
    source = "proxy_events" if kind == "blocked_events" else kind
    rows = payload_rows(events.where(target(F.col("stream_name")) == source), source)
    cells = columns_of(kind, SparkReader(F.col("v"), F.col("parent")))
    first = 1 if kind == "proxy_events" else 0
    typed = rows.select("dedupe_key", (F.col("row_sequence") + first).cast("long").alias("row_sequence"), *(c.alias(n) for n, c in cells.items()))
    missing = F.concat_ws(",", *(F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED[kind]))
    typed = typed.withColumn("error", F.nullif(missing, F.lit("")))
    if kind == "blocked_events":
        typed = typed.where("blocked = 1").withColumn("blocked_bytes", F.coalesce("given_bytes", F.col("bytes_up") + F.col("bytes_down"))).drop("blocked", "given_bytes", "bytes_up", "bytes_down")
    return typed


def messages(spark: SparkSession, d: str, *streams: str) -> DataFrame:
    """Messages of some streams, each once, in their latest readable copy; messages without one are left out."""
    rows = table(spark, d, "sync_events").where(F.col("stream_name").isin(*streams) & F.col("payload").isNotNull())
    return rows.groupBy("stream_name", "dedupe_key").agg(latest_payload().alias("payload")).where("payload is not null")


def records_sql(stream: str, inner: str | None = None) -> str:
    """The records of a stream: dedupe_key, payload, parent, i (from 1)."""
    whole = "CASE WHEN json_type(payload) = 'ARRAY' THEN CAST(payload AS JSON[]) ELSE [CAST(payload AS JSON)] END"
    rows = f"CASE WHEN json_type(payload, '$.{inner}') = 'ARRAY' THEN CAST(json_extract(payload, '$.{inner}') AS JSON[]) ELSE {whole} END" if inner else whole
    return (
        f"m AS (SELECT dedupe_key, {_LATEST} AS payload FROM ({_READABLE}) WHERE stream_name = '{stream}' GROUP BY 1 HAVING payload IS NOT NULL), "
        f"r AS (SELECT dedupe_key, payload AS parent, unnest({rows}) AS payload, generate_subscripts({rows}, 1) AS i FROM m)"
    )


def sink_sql(kind: str, records: str) -> str:
    """All columns of a sink over ``records`` (a WITH list that ends in r), shown as the queries show them."""
    cells = columns_of(kind, SqlReader())
    inner = ", ".join(f"{c} AS {n}" for n, c in cells.items())
    error = f"nullif(concat_ws(',', {', '.join(f'CASE WHEN {c} IS NULL THEN {chr(39)}{c}{chr(39)} END' for c in REQUIRED[kind])}), '') AS error"
    first = "i" if kind == "proxy_events" else "i - 1"
    rows = f"x AS (SELECT dedupe_key, CAST({first} AS BIGINT) AS row_sequence, {inner} FROM r), y AS (SELECT *, {error} FROM x)"
    shown = [n for n in cells if not (kind == "blocked_events" and n in ("blocked", "given_bytes", "bytes_up", "bytes_down"))]
    out = ", ".join(f"epoch_us({n}) AS {n}" if n in TIMES else f"CAST(json_array_length({n}) AS DOUBLE) AS {n}" if n in ARRAYS else f"CAST({n} AS DOUBLE) AS {n}" if n in MEASURES else n for n in shown)
    more = ", coalesce(given_bytes, bytes_up + bytes_down) AS blocked_bytes FROM y WHERE blocked = 1" if kind == "blocked_events" else " FROM y"
    return f"WITH {records}, {rows} SELECT dedupe_key, row_sequence, error, {out}{more}"


TIMES = ("event_time", "captured_at", "observed_at", "window_start", "window_end", "published_at", "detected_at", "first_event_at", "last_event_at", "snapshot_at", "first_seen", "last_seen")
ARRAYS = ("tags", "anomaly_reasons", "attack_chain", "factor_breakdown", "explanation", "sequence")
MEASURES = ("frequency_hz", "risk_score")


def shown(rows: DataFrame) -> DataFrame:
    """A sink's rows for comparison: times in microseconds, arrays as their size, all numbers as double."""
    cell = lambda f: (
        F.unix_micros(f.name) if f.name in TIMES else F.expr(f"json_array_length({f.name})") if f.name in ARRAYS else F.col(f.name)
    )
    number = lambda f: f.name in TIMES or f.name in ARRAYS or f.dataType.typeName() in ("integer", "long", "double")
    return rows.select(*((cell(f).cast("double") if number(f) else cell(f)).alias(f.name) for f in rows.schema.fields))


_TEXT = "CASE WHEN json_type(payload, '$.{0}') = 'VARCHAR' THEN nullif(json_extract_string(payload, '$.{0}'), '') END"
_LONG = "CASE WHEN json_type(payload, '$.{0}') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') THEN TRY_CAST(json_extract_string(payload, '$.{0}') AS BIGINT) END"

#: Sinks with the stream that feeds them here, and the member that holds their records.
STREAMS = {
    "proxy_events": ("proxy.events", None), "blocked_events": ("proxy.events", None), "wireless_audit_frames": ("wireless.audit", None), "wireless_bandwidth": ("audit.wireless.bandwidth", None),
    "client_inventory": ("wireless.client.inventory", "clients"), "probe_requests": ("wireless.probe.flush", "probes"), "attack_sequence": ("wireless.alert.attack_sequence", None), "sequence_alert": ("wireless.alert.sequence", None),
}


def doubles_sql(sql: str, texts: tuple[str, ...]) -> str:
    """Every column of a sink's SQL but the texts as double, as :func:`shown` has them."""
    return f"SELECT {', '.join(texts)}, CAST(COLUMNS(* EXCLUDE ({', '.join(texts)})) AS DOUBLE) FROM ({sql})"


def texts_of(kind: str) -> tuple[str, ...]:
    reader = SqlReader()
    text = []
    for n, c in columns_of(kind, reader).items():
        if n in TIMES or n in ARRAYS or n in MEASURES or n in ("blocked", "given_bytes", "bytes_up", "bytes_down") and kind == "blocked_events":
            continue
        if "BIGINT" not in c and "THEN 1" not in c:
            text.append(n)
    return ("dedupe_key", "error", *text)


def _transform_query(kind: str, stream: str, inner: str | None) -> None:
    @query(f"q30_{kind}", doubles_sql(sink_sql(kind, records_sql(stream, inner)), texts_of(kind)))
    def run(spark: SparkSession, d: str) -> DataFrame:
        return shown(transform(messages(spark, d, stream), kind))


for _kind, (_stream, _inner) in STREAMS.items():
    _transform_query(_kind, _stream, _inner)
