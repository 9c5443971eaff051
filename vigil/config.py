"""Typed settings of the engine."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS
UNITS_MS = {"millisecond": 1, "second": 1000, "minute": MINUTE_MS, "hour": HOUR_MS, "day": DAY_MS}


def duration_ms(text: str) -> int:
    """Milliseconds of a time such as `2 seconds`."""
    number, unit = text.split()
    return int(number) * UNITS_MS[unit.removesuffix("s")]


@dataclass(frozen=True)
class Settings:
    """Everything a user can tune. Limits, times and windows default to the fixed values of the live workload."""

    # Message source: any streaming format that yields one text or binary column.
    source_format: str = "text"
    source_path: str | None = None
    source_column: str = "value"
    source_options: dict[str, str] = field(default_factory=dict)

    # Training trigger: the Nth event of a device, then a pause.
    trigger_limit: int = 100
    cooldown_ms: int = 600_000

    # Training set: the latest readings of a device, loaded in numbered chunks.
    history_limit: int = 300
    chunk_rows: int = 100

    # Model catalog refresh and alerting.
    refresh_ms: int = 120_000
    # Live scores take the snapshot that is there when an event arrives, or that of the event's own time; in the
    # second case models are dated by their trigger, so that a replay gives the same distances.
    score_by: str = "arrival"
    threshold: float = 3.0

    # Window length and allowed lateness of each stage.
    persist_window: str = "2 seconds"
    persist_lateness: str = "2 seconds"
    training_window: str = "15 seconds"
    training_lateness: str = "30 seconds"
    score_window: str = "2 seconds"
    score_lateness: str = "120 seconds"
    persist_trigger: str = "1 second"
    training_trigger: str = "20 seconds"

    # Processing time from a window's first row to its firing: early and late panes, and the training pane.
    pane_delay: str = "1 second"
    training_delay: str = "20 seconds"

    # Physical layout. Work ordered within a device is split into time slices: readings are
    # keyed by (device, millisecond), so one slice holds at most `slice_ms` rows of a device.
    slice_ms: int = HOUR_MS
    salts: int = 32
    table_buckets: int = 16
    # Folders of a live table are folded every so many micro-batches.
    fold_batches: int = 100

    def __post_init__(self):
        for f in fields(self):
            if f.type == "int":
                object.__setattr__(self, f.name, int(getattr(self, f.name)))
                if getattr(self, f.name) <= 0:
                    raise ValueError(f"{f.name} must be positive")
        object.__setattr__(self, "threshold", float(self.threshold))
        if self.score_by not in ("arrival", "event time"):
            raise ValueError("score_by is arrival or event time")
