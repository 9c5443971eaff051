"""Panes: what a window has gathered since its last firing, handed out once, with the firing it belongs to.

A window of event time fires early, `delay_ms` of processing time after the first row that is not yet handed out;
on time, when the watermark has passed its end; and late, `delay_ms` after the first row that came behind the
watermark, or at the latest when the watermark is `lateness_ms` beyond the end. Rows that come after that are
dropped, and that too is told. The watermark is the greatest event time of the batches before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

EARLY, ON_TIME, LATE, DROPPED = "early", "on time", "late", "dropped"
PANE = "window_start bigint, firing string, batch_rows bigint, first_eventtime bigint, last_eventtime bigint"


class Panes(StatefulProcessor):
    """Per window five numbers, and none while nothing waits: rows, time range, when they fire, whether they are late."""

    def __init__(self, length_ms: int, lateness_ms: int, delay_ms: int):
        self.length_ms = length_ms
        self.lateness_ms = lateness_ms
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("waiting", "n BIGINT, first BIGINT, last BIGINT, due BIGINT, late BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, watermark = timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs()
        end = key[0] + self.length_ms
        parts = pd.concat(rows)
        n, first, last = int(parts["n"].sum()), int(parts["first"].min()), int(parts["last"].max())
        if end + self.lateness_ms <= watermark:
            yield self._pane(key, DROPPED, n, first, last)
            return
        late = end <= watermark
        if self.state.exists():
            held = self.state.get()
            if late and not held[4]:
                yield self._pane(key, ON_TIME, *held[:3])
                due = now + self.delay_ms
            else:
                n, first, last, due = n + held[0], min(first, held[1]), max(last, held[2]), held[3]
        else:
            due = now + self.delay_ms
        self.state.update((n, first, last, due, late))
        yield from self._fire(key, now, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._fire(key, timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs())

    def _fire(self, key, now: int, watermark: int) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        n, first, last, due, late = self.state.get()
        end = key[0] + self.length_ms
        passed = end <= watermark if not late else end + self.lateness_ms <= watermark
        if passed or due <= now:
            self.state.clear()
            yield self._pane(key, LATE if late else ON_TIME if passed else EARLY, n, first, last)
        else:
            self.handle.registerTimer(now + 1)  # the next batch looks at the watermark again

    @staticmethod
    def _pane(key, firing, n, first, last) -> pd.DataFrame:
        return pd.DataFrame({"window_start": [key[0]], "firing": [firing], "batch_rows": [n],
                             "first_eventtime": [first], "last_eventtime": [last]})

    def close(self) -> None:
        pass


def _partial(length_ms: int):
    """Counts and time range per window of an Arrow batch, so that a busy window shuffles few rows."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            times = batch["eventtime"]
            found = times.groupby(times - times % length_ms).agg(["size", "min", "max"])
            yield pd.DataFrame({"window_start": found.index.astype("int64"), "n": found["size"].astype("int64"),
                                "first": found["min"], "last": found["max"]})

    return partial


def pane_counts(events: DataFrame, length_ms: int, lateness_ms: int, delay_ms: int) -> DataFrame:
    """The panes of all windows of a stream of events (eventtime, event_ts): window_start, firing, batch_rows and the
    first and last eventtime. The panes of a window, dropped rows included, add up to its rows."""
    parts = events.withWatermark("event_ts", "0 seconds").select("eventtime").filter(
        F.col("eventtime").isNotNull()).mapInPandas(_partial(length_ms), "window_start bigint, n bigint, first bigint, last bigint")
    return parts.groupBy("window_start").transformWithStateInPandas(
        statefulProcessor=Panes(length_ms, lateness_ms, delay_ms),
        outputStructType=PANE, outputMode="append", timeMode="processingTime",
    )
