"""Control helpers of the streaming runner: back-pressure, retry delays, error classes, configuration."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# SQL states (two classes, three states), vendor codes and phrases of errors worth another try.
RETRYABLE_CLASSES = ("08", "40")
RETRYABLE_STATES = ("HYT00", "HYT01", "70100")
RETRYABLE_CODES = (1205, 1213, 1218, 2006, 2013, 2059, 8002, 9007, 9013, 9014, 40001)
RETRYABLE_PHRASES = ("timeout", "temporarily unavailable", "connection reset", "deadlock", "write conflict", "lock wait", "region unavailable")


@dataclass
class Backpressure:
    """Suspends at the budget and resumes at half of it."""

    budget: int = 4000
    suspended: bool = False

    def update(self, pending: int) -> bool:
        self.suspended = pending > self.budget // 2 if self.suspended else pending >= self.budget
        return self.suspended


def string_hash(text: str) -> int:
    """The 32-bit polynomial hash (factor 31) of a string's UTF-16 units, signed."""
    raw = text.encode("utf-16-be", "surrogatepass")
    h = 0
    for i in range(0, len(raw), 2):
        h = (31 * h + (raw[i] << 8 | raw[i + 1])) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def retry_delay_ms(attempt: int, key: str, base_ms: int = 1000, cap_ms: int = 8000) -> int:
    """Exponential delay up to the cap, spread by at most a fifth, the same for the same key."""
    delay = min(cap_ms, base_ms * 2 ** min(max(attempt, 0), 30))
    spread = (string_hash(f"{key}:{attempt}") % 401 - 200) / 1000
    return round(delay * (1 + spread))


def error_class(state: str | None = None, message: str | None = None, code: int = 0) -> str:
    """Whether an error is worth another try, by its SQL state, its vendor code (whatever the sign) or its text."""
    known = (state or "").upper()
    if known.startswith(RETRYABLE_CLASSES) or known in RETRYABLE_STATES or abs(code) in RETRYABLE_CODES:
        return "retryable"
    return "retryable" if any(p in (message or "").lower() for p in RETRYABLE_PHRASES) else "permanent"


def failure_class(failure: BaseException | None) -> str:
    """The class of an exception or of anything that caused it; each is looked at once."""
    seen: set[int] = set()
    while failure is not None and id(failure) not in seen:
        seen.add(id(failure))
        if error_class(getattr(failure, "sqlstate", None), str(failure), getattr(failure, "errno", None) or 0) == "retryable":
            return "retryable"
        failure = failure.__cause__ or failure.__context__
    return "permanent"


def with_retries(work: Callable[[], T], attempts: int = 3, base_ms: int = 500, sleep: Callable[[float], None] = time.sleep) -> T:
    """Run ``work`` again after failures worth it, with doubling delays; the last failure is raised."""
    for n in range(attempts):
        try:
            return work()
        except Exception as e:
            if n + 1 == attempts or failure_class(e) == "permanent":
                raise
            sleep(base_ms * 2**n / 1000)
    raise ValueError("attempts must be positive")


@dataclass
class Lease:
    """A right to work that its owner must renew; ``fence`` grows with every owner, so that a late one is told apart."""

    interval_s: float
    owner: str | None = None
    fence: int = 0
    expires: float = 0.0

    @property
    def ttl(self) -> float:
        return max(2 * self.interval_s, 30.0)

    @property
    def renew_after(self) -> float:
        return self.ttl / 3

    def claim(self, owner: str, now: float) -> int | None:
        """The fence of a new holder; None while another holds it."""
        if self.owner not in (None, owner) and now < self.expires:
            return None
        if self.owner != owner or now >= self.expires:
            self.fence += 1
        self.owner, self.expires = owner, now + self.ttl
        return self.fence

    def renew(self, owner: str, fence: int, now: float) -> bool:
        held = self.owner == owner and self.fence == fence and now < self.expires
        if held:
            self.expires = now + self.ttl
        return held

    def release(self, owner: str, fence: int) -> bool:
        held = self.owner == owner and self.fence == fence
        if held:
            self.owner, self.expires = None, 0.0
        return held


@dataclass
class StreamConfig:
    """Settings of an ingest stream; validated before anything starts."""

    streams: tuple[str, ...] = ()
    topic: str = "ledger.requests"
    group: str = "ingest-v1"
    max_offsets_per_trigger: int = 500
    watermark_minutes: int = 60
    problems: list[str] = field(default_factory=list)

    def validate(self) -> StreamConfig:
        self.streams = tuple(s.strip() for s in self.streams if s and s.strip())
        if not self.streams:
            self.problems.append("no stream is configured")
        if "." not in self.topic or not all(c.isalnum() or c in "._-" for c in self.topic):
            self.problems.append(f"bad topic {self.topic!r}")
        version = self.group.rpartition("v")[2]
        if not (self.group.rpartition("v")[0].endswith(("-", "_", ".")) and version.isdigit() and not version.startswith("0")):
            self.problems.append("the consumer group must end in a version such as -v1")
        if self.max_offsets_per_trigger < 1 or self.watermark_minutes < 1:
            self.problems.append("sizes must be positive")
        if self.problems:
            raise ValueError("; ".join(self.problems))
        return self

    def kafka_options(self, servers: str) -> dict[str, str]:
        """Options of the Kafka source: from the earliest offset, committed records only, bounded batches."""
        return {
            "kafka.bootstrap.servers": servers, "subscribe": self.topic, "startingOffsets": "earliest", "kafka.isolation.level": "read_committed",
            "maxOffsetsPerTrigger": str(self.max_offsets_per_trigger), "groupIdPrefix": self.group, "failOnDataLoss": "true",
        }

    def source(self, spark: SparkSession, servers: str) -> DataFrame:
        """The Kafka source as records ``topic, partition, offset, key, value``; needs the connector on the class path."""
        raw = spark.readStream.format("kafka").options(**self.kafka_options(servers)).load()
        return raw.selectExpr("topic", "partition", "offset", "cast(key as string) key", "cast(value as string) value")
