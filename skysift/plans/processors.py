"""The processors as names, what each depends on, and the queries that do its work."""

from __future__ import annotations

# Processor, processors it needs, queries.
PROCESSORS = {
    "sync-scan-ingestion": ((), ("st01_dedupe_stream", "st03_dlq_split", "st04_scan_requests", "q39_dedupe_first", "q40_tombstone_filter")),
    "sync-job-planner": (("sync-scan-ingestion",), ("q48_job_planner", "q48d_jobs", "q48e_batches", "q48f_job_batches")),
    "sync-backlog-recovery": ((), ("st07_backlog", "q43b_backlog_states")),
    "sync-load-dispatch": (("sync-job-planner",), ("q36_oldest_pending", "q36b_outbox_due")),
    "sync-outbox-publisher": (("sync-load-dispatch",), ("q36c_outbox_states",)),
    "sync-load-consumer": (("sync-outbox-publisher",), ("st05_load_stream", "q23_rollup_fold", "q24_daily_alert_merge", "q30_proxy_events", "q43c_alert_table")),
    "sync-result-consumer": (("sync-load-consumer",), ("st06_result_stream", "q41_cursor_max", "q48b_result_transition")),
    "wireless-frame-normalizer": (("sync-load-consumer",), ("q09_wireless_frames", "q09c_unprojected_children", "q29_json_projection")),
    "wireless-inventory-projector": (("wireless-frame-normalizer",), ("q26_inventory_upsert", "q27_probe_merge")),
    "behavior-projector": (("wireless-frame-normalizer",), ("q02_behavior_snapshot", "q07_stale_windows", "q07d_stale_frames")),
    "timing-projector": (("wireless-frame-normalizer",), ("q03_timing_profile",)),
    "sequence-projector": (("wireless-frame-normalizer",), ("q04_session_sequence", "q05_transition_probabilities")),
    "baseline-projector": (("behavior-projector", "timing-projector"), ("q06_baseline_percentiles",)),
    "embedding-text-builder": (("wireless-inventory-projector",), ("q31_tokens", "q33_tags", "q34b_document_upsert", "q35b_event_documents", "q35c_behaviour_documents", "q35d_device_documents", "q35e_sequence_documents")),
    "embedding-preparer": (("embedding-text-builder",), ("q35_missing_jobs",)),
    "similarity-projector": (("embedding-preparer",), ("q16_knn_topk", "q16d_anchor_pairs", "q17_similarity_pairs")),
    "clustering-projector": (("similarity-projector",), ("q17b_merge_candidates",)),
    "wireless-identity-projector": (("wireless-inventory-projector", "similarity-projector"), ("q18_identity_clusters", "q18d_cluster_members", "q18e_inventory_devices")),
    "graph-projector": (("wireless-identity-projector",), ("q19_graph_nodes", "q20_graph_edges")),
    "dns-alert-projector": (("sync-load-consumer",), ("q21_dns_threat",)),
    "rf-alert-projector": (("baseline-projector", "sequence-projector"), ("q12_shadow_alerts", "q12b_shadow_alert_json")),
    "risk-projector": (("dns-alert-projector", "rf-alert-projector"), ("q22_entity_risk",)),
    "event-retention": ((), ("q15_retention_eligible", "q15c_retention_cascade", "q15d_tombstones", "q45e_archive_path")),
    "search-retention": ((), ("q15b_search_retention",)),
    "stale-worker-cleanup": ((), ("q48c_stale_cleanup",)),
    "scheduled-reconciliation": ((), ("q13_missing_children", "q14_resolved_findings")),
}


def run(spark, root: str, enabled: set[str]) -> dict:
    """The outputs of enabled processors by query, in the order of what they need."""
    from skysift.plans.catalogue import QUERIES

    return {q: QUERIES[q](spark, root) for name in in_order(enabled) for q in PROCESSORS[name][1]}


def in_order(enabled: set[str]) -> list[str]:
    """Enabled processors, each after what it needs; one that needs a disabled one is an error."""
    for name in enabled:
        lacking = [n for n in PROCESSORS[name][0] if n not in enabled]
        if lacking:
            raise ValueError(f"{name} needs {', '.join(lacking)}")
    return [n for n in PROCESSORS if n in enabled]
