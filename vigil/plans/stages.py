"""The named stages of the engine over bounded input, each a DataFrame to DataFrame function.

Replaying a stored stream gives the same rows whenever it is run: arrival order is event-time order,
and processing time is event time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.config import Settings
from vigil.functions.codec import decode_messages, to_distances, to_readings, with_event_time
from vigil.functions.numeric import SLICE, own_slice, with_slice
from vigil.operators.catalog import model_snapshots
from vigil.operators.scoring import anomalies, score_as_of, to_alerts
from vigil.operators.training import fit_models, history_at_triggers
from vigil.operators.trigger import collection_triggers
from vigil.operators.upsert import merge_upsert
from vigil.session import materialize, materialize_by


def save_and_timestamp_events(raw: DataFrame) -> DataFrame:
    """Raw messages to device events with event time."""
    return with_event_time(decode_messages(raw))


def stored_readings(events: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """The readings table after the value writes of these events."""
    writes = to_readings(events)
    return merge_upsert(base, [writes], ["device_id", "eventtime", *own_slice(writes)])


def count_and_collect_events(events: DataFrame, settings: Settings) -> DataFrame:
    """The training rows of every trigger: (device_id, trained_at, rn, chunk, eventtime, value)."""
    triggers = collection_triggers(events, settings.trigger_limit, settings.cooldown_ms, settings.slice_ms)
    # Few rows that cost a pass over everything and are read more than once.
    triggers = materialize(triggers, "triggers")
    return history_at_triggers(
        stored_readings(events), triggers, settings.history_limit, settings.chunk_rows, settings.slice_ms
    )


def train_models(collected: DataFrame) -> DataFrame:
    """One model version per device and trigger."""
    return fit_models(collected, "trained_at")


def load_models(versions: DataFrame, settings: Settings) -> DataFrame:
    """The catalog as scorers see it from tick to tick."""
    return model_snapshots(versions, settings.refresh_ms)


def calculate_distances(events: DataFrame, versions: DataFrame, settings: Settings) -> DataFrame:
    """Events with their distance, each from the model version visible at its time."""
    return score_as_of(events, versions, settings.refresh_ms, settings.slice_ms)


def save_distances(readings: DataFrame, scores: DataFrame) -> DataFrame:
    """The readings table after the distance writes of these scores."""
    return merge_upsert(readings, [to_distances(scores)], ["device_id", "eventtime"])


def alerts_from_messages(raw: DataFrame, settings: Settings, notified_at: Column | None = None) -> DataFrame:
    """The whole chain: decode, trigger, collect, train, refresh, score, alert."""
    # The text is parsed once, and events are shuffled once: every later step works by device and slice.
    sliced = with_slice(decode_messages(raw), "eventtime", settings.slice_ms)
    events = materialize_by(sliced, ["id", SLICE], "events")
    versions = train_models(count_and_collect_events(events, settings))
    found = anomalies(calculate_distances(events, versions, settings), settings.threshold)
    return to_alerts(found, F.current_timestamp() if notified_at is None else notified_at)
