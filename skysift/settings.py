"""Settings of the processors: defaults, overrides from the environment, and all that is wrong with them at once."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from typing import NamedTuple

_MANY = float("inf")


class Number(NamedTuple):
    default: float
    low: float = 1
    high: float = _MANY


# Numeric settings with their defaults and bounds.
NUMBERS = {
    "kafka.max-poll-records": Number(500), "kafka.poll-timeout-ms": Number(1000), "kafka.topic-partitions": Number(24), "kafka.topic-replication-factor": Number(1, 1, 32767), "kafka.locked-batch-size": Number(500), "kafka.locked-batch-window-ms": Number(250),
    "wireless.consumers-count": Number(1), "wireless.max-poll-records": Number(500),
    "backpressure.budget-multiplier": Number(4),
    "cron.ingest-batch-size": Number(1000), "cron.dispatch-batch-size": Number(50), "cron.scan-max-attempts": Number(5), "cron.scan-retry-backoff-seconds": Number(5), "cron.batch-dispatch-retry-max-seconds": Number(300), "cron.batch-dispatch-lease-seconds": Number(60), "cron.batch-max-attempts": Number(5),
    "processors.batch-size": Number(250), "processors.interval-seconds": Number(10), "processors.restart-base-delay-ms": Number(1000), "processors.restart-max-delay-ms": Number(60000),
    "processors.event-duplicate-distance": Number(0.05, 0, 2), "processors.behavior-similarity-threshold": Number(0.88, -1, 1), "processors.sequence-distance-threshold": Number(0.10, 0, 2),
    "archive.hot-days": Number(7), "archive.event-retention-days": Number(30), "archive.search-retention-days": Number(30), "archive.tombstone-retention-days": Number(45), "archive.batch-size": Number(500),
}
# Settings of which the first must be at least the second.
AT_LEAST = (
    ("kafka.max-poll-records", "kafka.locked-batch-size"), ("processors.restart-max-delay-ms", "processors.restart-base-delay-ms"), ("archive.event-retention-days", "archive.hot-days"),
    ("archive.tombstone-retention-days", "archive.event-retention-days"), ("cron.batch-dispatch-retry-max-seconds", "cron.scan-retry-backoff-seconds"),
)
LISTS = ("ingest.stream-names", "ingest.load-stream-names", "processors.enabled", "kafka.groups")
TEXTS = {"kafka.dlq-suffix": ".dlq", "processors.embedding-model": "all-MiniLM-L6-v2"}
PREFIX = "SKYSIFT_"


def variable(name: str) -> str:
    """The environment variable that overrides a setting."""
    return PREFIX + re.sub(r"[^A-Z0-9]", "_", name.upper())


def settings(given: Mapping[str, object] | None = None, environment: Mapping[str, str] | None = None) -> dict[str, object]:
    """Defaults, then what is given, then the environment. Anything wrong is an error that names all of it."""
    given, environment = dict(given or {}), os.environ if environment is None else environment
    values: dict[str, object] = {**{n: x.default for n, x in NUMBERS.items()}, **TEXTS, **{n: () for n in LISTS}}
    wrong = [f"{n} is not known" for n in given if n not in values]
    values |= {n: v for n, v in given.items() if n in values}
    for n in values:
        if variable(n) in environment:
            values[n] = environment[variable(n)]
    for n, x in NUMBERS.items():
        try:
            values[n] = type(x.default)(values[n])
        except (TypeError, ValueError):
            wrong.append(f"{n} is no number")
            values[n] = x.default
            continue
        if not x.low <= values[n] <= x.high:
            wrong.append(f"{n} must be at least {x.low}" if x.high == _MANY else f"{n} must be between {x.low} and {x.high}")
    wrong += [f"{a} must be at least {b}" for a, b in AT_LEAST if values[a] < values[b]]
    wrong += [f"{n} must not be blank" for n in TEXTS if not str(values[n]).strip()]
    for n in LISTS:
        items = values[n].split(",") if isinstance(values[n], str) else list(values[n])
        items = [str(i).strip() for i in items] if items != [""] else []
        values[n] = tuple(items)
        if "" in items:
            wrong.append(f"{n} must not hold blank names")
        if len(set(items)) < len(items):
            wrong.append(f"{n} must not hold a name twice")
    streams, loaded = values["ingest.stream-names"], values["ingest.load-stream-names"]
    if streams and "proxy.events" not in streams:
        wrong.append("ingest.stream-names must hold proxy.events")
    if not set(loaded) <= set(streams):
        wrong.append("ingest.load-stream-names must be among ingest.stream-names")
    wrong += [f"kafka.groups: {g} must end in a version such as -v1" for g in values["kafka.groups"] if not re.search(r"[-_.]v[1-9][0-9]*\Z", g)]
    from skysift.plans.processors import PROCESSORS, in_order

    unknown = [n for n in values["processors.enabled"] if n and n not in PROCESSORS]
    wrong += [f"processors.enabled: {n} is not known" for n in unknown]
    if not unknown:
        try:
            in_order({n for n in values["processors.enabled"] if n})
        except ValueError as e:
            wrong.append(f"processors.enabled: {e}")
    if wrong:
        raise ValueError("; ".join(wrong))
    return values
