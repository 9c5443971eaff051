"""The processors of panes by themselves, with a hand-made clock and watermark."""

import pandas as pd
import pytest

from vigil.streaming.counter import PaneCounter
from vigil.streaming.panes import Panes


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Map:
    def __init__(self):
        self.held = {}

    def exists(self):
        return bool(self.held)

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value

    def iterator(self):
        return iter(self.held.items())

    def removeKey(self, key):
        del self.held[key]


class Run:
    """A processor with state, timers, time and watermark."""

    def __init__(self, processor, key):
        self.processor, self.key, self.now, self.mark, self.timers = processor, (key,), 0, 0, set()
        processor.init(self)

    def getValueState(self, name, schema):
        return Value()

    def getMapState(self, name, key, value):
        return Map()

    def registerTimer(self, at):
        self.timers.add(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getCurrentWatermarkInMs(self):
        return self.mark

    def batch(self, now, mark, rows=None):
        self.now, self.mark = now, mark
        out = [] if rows is None else list(self.processor.handleInputRows(self.key, iter([rows]), self))
        due = {t for t in self.timers if t <= now}
        self.timers -= due
        for _ in sorted(due)[:1]:
            out += list(self.processor.handleExpiredTimer(self.key, self, None))
        return [tuple(r) for frame in out for r in frame.itertuples(index=False)]


def rows(n, first, last):
    return pd.DataFrame({"n": [n], "first": [first], "last": [last]})


def test_early_on_time_late_and_dropped():
    run = Run(Panes(2000, 5000, 1000), 10_000)
    assert run.batch(0, 9_000, rows(2, 10_100, 10_200)) == []
    assert run.batch(500, 9_500, rows(1, 10_050, 10_050)) == []
    assert run.batch(1000, 9_500) == [(10_000, "early", 3, 10_050, 10_200)]
    assert run.batch(1100, 11_000, rows(1, 11_900, 11_900)) == []
    assert run.batch(1200, 12_000, rows(4, 10_000, 10_001)) == [(10_000, "on time", 1, 11_900, 11_900)]
    assert run.batch(1300, 12_000) == []
    assert run.batch(2200, 12_000) == [(10_000, "late", 4, 10_000, 10_001)]
    assert run.batch(2300, 13_000, rows(1, 11_000, 11_000)) == []
    assert run.batch(2400, 17_000, rows(5, 11_001, 11_001)) == [
        (10_000, "dropped", 5, 11_001, 11_001), (10_000, "late", 1, 11_000, 11_000)]
    assert run.processor.state.held is None and run.batch(9_000, 17_000) == []


def test_nothing_held_fires_nothing():
    run = Run(Panes(2000, 5000, 0), 0)
    assert run.batch(0, 0, rows(1, 5, 5)) == [(0, "early", 1, 5, 5)]
    assert run.batch(10, 9_000) == [] and run.batch(20, 90_000, rows(1, 6, 6)) == [(0, "dropped", 1, 6, 6)]


@pytest.mark.parametrize("delay", [0, 20])
def test_a_training_pane_fires_once(delay):
    run = Run(PaneCounter(1, 1, 15_000, 30_000, delay), 7)

    def times(*at):
        return pd.DataFrame({"id": [7], "times": [list(at)]})

    found = run.batch(100, 0, times(16_000))
    assert found[0] == (7, 16_000, "trigger", 15_000, 1, 0)
    if delay:
        assert len(found) == 1 and run.batch(110, 0) == []
        assert run.batch(112, 0, times(17_000)) == [(7, 17_000, "trigger", 15_000, 1, 0)]
        assert run.batch(120, 0) == [(7, 17_000, "pane", 15_000, 2, 0)]
    else:
        assert found[1:] == [(7, 16_000, "pane", 15_000, 1, 0)]
    # The pane has fired, and is forgotten only when its window is over.
    assert run.batch(200, 0, times(18_000))[1:] == [(7, 18_000, "too late", 15_000, 1, 0)]
    assert run.batch(90_000, 60_000) == [] and not run.processor.panes.held
    assert run.batch(90_100, 60_000, times(18_500))[1:] == [(7, 18_500, "too late", 15_000, 1, 60_000)]
    assert run.batch(90_200, 60_000, times(30_001))[0][2:4] == ("trigger", 30_000)


def test_a_pane_whose_window_is_over_does_not_wait():
    run = Run(PaneCounter(1, 1, 15_000, 30_000, 10_000), 7)
    assert len(run.batch(0, 0, pd.DataFrame({"id": [7], "times": [[1_000]]}))) == 1
    assert run.batch(50, 50_000, pd.DataFrame({"id": [7], "times": [[40_000]]}))[1:] == [(7, 1_000, "pane", 0, 1, 50_000)]
