"""One settings object for the ingest job; nothing else carries defaults."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from sensorweave.schemas import DEFAULT_SENSOR_ID


@dataclass(frozen=True)
class IngestConfig:
    """Where readings come from, where they go and how often.

    ``table_root`` and ``checkpoint_root`` must be on storage every executor
    sees and must stay the same across restarts.
    """

    table_root: str
    checkpoint_root: str
    kafka_servers: str = "kafka:9092"
    topic: str = "sensor-data"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    codec: str = "json"
    default_sensor_id: str = DEFAULT_SENSOR_ID
    trigger_interval: str = "1 second"
    console: bool = False
    jdbc: Mapping[str, str] | None = field(default=None)

    @classmethod
    def from_mapping(cls, values: Mapping[str, object]) -> "IngestConfig":
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(values) - known)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return cls(**values)

    def table(self, name: str) -> str:
        return f"{self.table_root.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{name}"
