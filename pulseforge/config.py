"""Run parameters, checked once when the object is built."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

# Topic, group and table names that existing producers,
# consumers and dashboards already use.
TOPIC_RAW = "events.raw.v1"
TOPIC_INVALID = "events.invalid.v1"
TOPIC_ANOMALY = "events.anomaly.v1"
TOPIC_DLQ = "events.dlq.v1"
GROUP_WRITER = "cg.db-writer.v1"
GROUP_DETECTOR = "cg.anomaly.v1"
EVENTS_TABLE = "heartbeat_events"
ANOMALIES_TABLE = "anomalies"
CHECKPOINT_TABLE = "ingest_checkpoint"

# Bounds every reading must meet, whatever the deployment.
HARD_RATE_MIN = 0
HARD_RATE_MAX = 250
CUSTOMER_ID_MAX = 64

# Smallest accepted value of each range-checked parameter.
MINIMUM = {
    "heart_rate_min": 0,
    "heart_rate_max": 1,
    "anomaly_low_threshold": 0,
    "anomaly_high_threshold": 1,
    "anomaly_spike_delta": 1,
    "history_depth": 1,
    "lookback_chunk": 1,
    "throughput_seconds": 1,
    "topic_partitions": 1,
}


@dataclass(frozen=True)
class Settings:
    """Thresholds and names used by the operators.

    ``lookback_chunk`` is the number of source offsets that one window group
    may span (see ``operators.lookback``); it bounds what a single task sorts
    for one customer, however hot that customer is.
    """

    heart_rate_min: int = 45
    heart_rate_max: int = 185
    anomaly_low_threshold: int = 50
    anomaly_high_threshold: int = 140
    anomaly_spike_delta: int = 30
    history_depth: int = 6
    lookback_chunk: int = 1 << 20
    throughput_seconds: int = 5
    throughput_min_eps: float = 500.0
    topic_partitions: int = 24
    topic_raw: str = TOPIC_RAW
    topic_invalid: str = TOPIC_INVALID
    topic_anomaly: str = TOPIC_ANOMALY
    topic_dlq: str = TOPIC_DLQ
    group_writer: str = GROUP_WRITER
    group_detector: str = GROUP_DETECTOR
    bootstrap_servers: str = "localhost:19092"

    def __post_init__(self) -> None:
        for f in fields(self):
            value = getattr(self, f.name)
            kind = {"int": int, "float": (int, float), "str": str}[f.type]
            if isinstance(value, bool) or not isinstance(value, kind):
                raise ValueError(f"{f.name} must be of type {f.type}, got {value!r}")
            if f.name in MINIMUM and value < MINIMUM[f.name]:
                raise ValueError(f"{f.name} must be at least {MINIMUM[f.name]}, got {value}")
        if self.throughput_min_eps < 0:
            raise ValueError("throughput_min_eps must not be negative")

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> "Settings":
        """Build from environment-style text values; names are case-insensitive
        and unknown ones are ignored."""
        given = {k.lower(): v for k, v in values.items()}
        renamed = {
            "kafka_bootstrap_servers": "bootstrap_servers",
            "kafka_topic_raw": "topic_raw",
            "kafka_topic_invalid": "topic_invalid",
            "kafka_topic_anomaly": "topic_anomaly",
            "kafka_topic_dlq": "topic_dlq",
            "kafka_consumer_group_db": "group_writer",
            "kafka_consumer_group_anomaly": "group_detector",
            "load_test_min_eps": "throughput_min_eps",
        }
        for env_name, own_name in renamed.items():
            if env_name in given:
                given[own_name] = given[env_name]
        casts = {"int": int, "float": float, "str": str}
        return cls(**{f.name: casts[f.type](given[f.name]) for f in fields(cls) if f.name in given})


DEFAULTS = Settings()
