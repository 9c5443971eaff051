"""The trigger counter on a live stream: counts arrivals, pauses in processing time.

Within a micro-batch the events of a device are taken in event-time order, so that the event which
completes a count does not depend on how Spark deals out the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


#: Devices are dealt over so many parts. A part is one key of the state, with an entry for each of its devices, as a key
#: of its own costs a device several milliseconds a batch. Fixed, as state is found again by it.
PARTS = 1024


class EventCounter(StatefulProcessor):
    """Per device two numbers: events seen since the last restart, and when its pause ends (0: none).

    A device fires at most once per micro-batch: what follows in the same batch lies within the pause. A
    pause that is over counts as none at once; the timer only forgets devices that stay silent. A batch reads and
    writes the entries of the devices that it holds, and a timer those that fired in one batch.
    """

    def __init__(self, limit: int, cooldown_ms: int):
        self.limit = limit
        self.cooldown_ms = cooldown_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "id INT", "seen BIGINT, pause_end BIGINT")
        self.pauses = handle.getMapState("pauses", "pause_end BIGINT", "ids ARRAY<INT>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        known = self.counts.exists()
        ids, at = [], []
        for device, times in _by_device(rows):
            seen = 0
            if known and self.counts.containsKey((device,)):
                seen, pause_end = self.counts.getValue((device,))
                if pause_end > now:
                    continue
                if pause_end > 0:
                    seen = 0
            if seen + len(times) >= self.limit:
                ids.append(device)
                at.append(int(np.partition(times, self.limit - seen - 1)[self.limit - seen - 1]))
                self.counts.updateValue((device,), (0, now + self.cooldown_ms))
            else:
                self.counts.updateValue((device,), (seen + len(times), 0))
        if ids:
            self._pause(ids, now + self.cooldown_ms)
            yield pd.DataFrame({"id": ids, "eventtime": at})

    def _pause(self, ids: list[int], until: int) -> None:
        held = self.pauses.getValue((until,))[0] if self.pauses.exists() and self.pauses.containsKey((until,)) else []
        self.pauses.updateValue((until,), ([*held, *ids],))
        self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        # As many entries as batches in which devices of the part began a pause that is not over.
        for (until,), (ids,) in list(self.pauses.iterator()) if self.pauses.exists() else []:
            if until <= now:
                for device in ids:
                    # Rows of the same batch come first and may have begun a newer count or pause.
                    if self.counts.containsKey((device,)) and 0 < self.counts.getValue((device,))[1] <= now:
                        self.counts.removeKey((device,))
                self.pauses.removeKey((until,))
        return iter(())

    def close(self) -> None:
        pass


def _by_device(rows: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray]]:
    """Each device of some packed rows with all its times."""
    found: dict[int, list[np.ndarray]] = {}
    for batch in rows:
        for device, times in zip(batch["id"].tolist(), batch["times"]):
            found.setdefault(device, []).append(np.asarray(times, np.int64))
    for device, times in found.items():
        yield device, times[0] if len(times) == 1 else np.concatenate(times)


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per device and Arrow batch with all its times, so that a busy device shuffles few rows."""
    for batch in batches:
        times = batch.groupby("id", sort=False)["eventtime"].agg(list)
        yield pd.DataFrame({"id": times.index.astype("int32"), "times": times.to_numpy()})


def count_triggers(events: DataFrame, limit: int, cooldown_ms: int) -> DataFrame:
    """(id, eventtime) of every trigger; only these two columns reach Python."""
    return _counted(events, EventCounter(limit, cooldown_ms), "id int, eventtime bigint")


def _counted(events: DataFrame, counter: EventCounter, schema: str) -> DataFrame:
    packed = events.select("id", "eventtime").mapInPandas(_packed, "id int, times array<bigint>")
    return packed.withColumn("part", F.pmod(F.hash("id"), F.lit(PARTS))).groupBy("part").transformWithStateInPandas(
        statefulProcessor=counter, outputStructType=schema, outputMode="append", timeMode="processingTime",
    )


TRIGGERED, PANE_FIRED, TOO_LATE = "trigger", "pane", "too late"
PANED = "id int, eventtime bigint, firing string, window_start bigint, n bigint, watermark bigint"


class PaneCounter(EventCounter):
    """Counts as `EventCounter` does, and gathers each device's triggers in windows of event time.

    The pane of a window fires once: `delay_ms` of processing time after its first trigger, or as soon as the
    watermark is `lateness_ms` beyond its end. A trigger that comes when its pane has fired or its window is that far
    behind is too late. A device has one pane for each window of at least one trigger, until that window is over.
    The open panes of a part are looked at together, when rows or a timer of the part come.
    """

    def __init__(self, limit: int, cooldown_ms: int, length_ms: int, lateness_ms: int, delay_ms: int):
        super().__init__(limit, cooldown_ms)
        self.length_ms = length_ms
        self.lateness_ms = lateness_ms
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.panes = handle.getMapState(
            "panes", "id INT, window_start BIGINT", "n BIGINT, last BIGINT, due BIGINT, fired BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, watermark = timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs()
        held, out = self._held(), []
        panes = dict(held)
        for found in super().handleInputRows(key, rows, timerValues):
            for device, at in zip(found["id"].tolist(), found["eventtime"].tolist()):
                start = at - at % self.length_ms
                out.append((device, at, TRIGGERED, start, 1, watermark))
                n, last, due, fired = panes.get((device, start), (0, at, now + self.delay_ms, False))
                if fired or self._over(start, watermark):
                    out.append((device, at, TOO_LATE, start, 1, watermark))
                else:
                    panes[device, start] = n + 1, max(last, at), due, False
        yield from self._fire(held, panes, out, now, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
        held = self._held()
        yield from self._fire(
            held, dict(held), [], timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs())

    def _held(self) -> dict[tuple[int, int], tuple]:
        return {tuple(k): tuple(v) for k, v in self.panes.iterator()} if self.panes.exists() else {}

    def _over(self, start: int, watermark: int) -> bool:
        return start + self.length_ms + self.lateness_ms <= watermark

    def _fire(self, held: dict, panes: dict, out: list, now: int, watermark: int) -> Iterator[pd.DataFrame]:
        """Add the panes that fire to `out`, keep what has changed since the state was read, and hand out."""
        looks = set()
        for (device, start), (n, last, due, fired) in panes.items():
            over = self._over(start, watermark)
            if not fired and (over or due <= now):
                out.append((device, last, PANE_FIRED, start, n, watermark))
                fired = True
            if over:
                if (device, start) in held:
                    self.panes.removeKey((device, start))
                continue
            if held.get((device, start)) != (n, last, due, fired):
                self.panes.updateValue((device, start), (n, last, due, fired))
            # Those that have fired are looked at together, so that few timers wait.
            wait = max(self.lateness_ms, 1)
            looks.add(now + wait - now % wait if fired else max(due, now + 1))
        for look in looks:
            self.handle.registerTimer(look)
        if out:
            yield pd.DataFrame(out, columns=["id", "eventtime", "firing", "window_start", "n", "watermark"])


def count_panes(
    events: DataFrame, limit: int, cooldown_ms: int, length_ms: int, lateness_ms: int, delay_ms: int
) -> DataFrame:
    """Triggers, panes and triggers that are too late, of a stream of events (id, eventtime, event_ts). The watermark is
    the greatest event time of the batches before."""
    marked = events.withWatermark("event_ts", "0 seconds")
    return _counted(marked, PaneCounter(limit, cooldown_ms, length_ms, lateness_ms, delay_ms), PANED)
