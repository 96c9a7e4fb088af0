"""Parameters of the pipeline.

Defaults follow the behaviour being reproduced; every one of them can be
overridden by the caller (no credentials or endpoints live here).
"""

from __future__ import annotations

import os
from dataclasses import dataclass


@dataclass(frozen=True)
class FraudRule:
    """`amount > amount_threshold AND tenure < tenure_days`, both strict."""

    amount_threshold: float = 1000.0
    tenure_days: int = 30

    @classmethod
    def from_env(cls, env=os.environ) -> "FraudRule":
        """Thresholds from FRAUD_AMOUNT_THRESHOLD / FRAUD_TENURE_THRESHOLD."""
        return cls(float(env.get("FRAUD_AMOUNT_THRESHOLD", cls.amount_threshold)),
                   int(env.get("FRAUD_TENURE_THRESHOLD", cls.tenure_days)))

    @property
    def reason(self) -> str:
        # Fixed value: the alert text format of the stream job.
        return (
            f"High value order (>${float(self.amount_threshold)}) "
            f"from new customer (<{int(self.tenure_days)} days)"
        )


@dataclass(frozen=True)
class WindowSpec:
    """Tumbling revenue windows with an event-time watermark."""

    window: str = "5 minutes"
    watermark: str = "10 minutes"
    trigger: str = "5 seconds"
    aggregate_trigger: str = "30 seconds"

    @classmethod
    def from_env(cls, env=os.environ) -> "WindowSpec":
        """Durations from WINDOW_DURATION / WATERMARK_DELAY / TRIGGER_INTERVAL."""
        return cls(env.get("WINDOW_DURATION", cls.window), env.get("WATERMARK_DELAY", cls.watermark),
                   env.get("TRIGGER_INTERVAL", cls.trigger))


@dataclass(frozen=True)
class TopicSpec:
    """Topic names and read limits of the order stream.

    ``max_offsets_per_trigger`` caps what one micro-batch reads (0: no cap);
    the default is the documented one of the stream job, to be raised with
    the cluster.
    """

    input_topic: str = "orders.raw"
    alert_topic: str = "fraud.alerts"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 1000

    @classmethod
    def from_env(cls, env=os.environ) -> "TopicSpec":
        """From KAFKA_INPUT_TOPIC, KAFKA_OUTPUT_TOPIC, KAFKA_STARTING_OFFSETS and MAX_OFFSETS_PER_TRIGGER."""
        return cls(env.get("KAFKA_INPUT_TOPIC", cls.input_topic), env.get("KAFKA_OUTPUT_TOPIC", cls.alert_topic),
                   env.get("KAFKA_STARTING_OFFSETS", cls.starting_offsets),
                   int(env.get("MAX_OFFSETS_PER_TRIGGER", cls.max_offsets_per_trigger)))


# Product categories and their price ranges (min, max) used by
# the generator-side quality checks.
CATEGORIES = ("electronics", "clothing", "books", "home", "sports")
CATEGORY_PRICE_RANGES = {
    "electronics": (50, 2000),
    "clothing": (20, 300),
    "books": (10, 50),
    "home": (30, 500),
    "sports": (25, 400),
}


DEFAULT_RULE = FraudRule()
DEFAULT_WINDOW = WindowSpec()
DEFAULT_TOPICS = TopicSpec()
