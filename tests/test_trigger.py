import random

import numpy as np
import pytest

from vigil.operators.trigger import collection_triggers


def replay(times, limit, cooldown):
    """The rule, one event at a time."""
    seen, pause_end, hits = 0, None, []
    for t in sorted(times):
        if pause_end is not None and t < pause_end:
            continue
        seen += 1
        if seen >= limit:
            hits.append(t)
            seen, pause_end = 0, t + cooldown
    return hits


def patterns(seed):
    """Device histories that stress different parts: dense, sparse, bursts, gaps, repeats, short."""
    rng = random.Random(seed)
    start = 1_700_000_000_000
    return {
        1: [start + 500 * i for i in range(600)],
        2: sorted(rng.sample(range(start, start + 2_000_000), 500)),
        3: [start + g * 900_000 + rng.randrange(3_000) for g in range(12) for _ in range(40)],
        4: [start + rng.randrange(50) for _ in range(300)],
        5: [start + 7 * 86_400_000 * i for i in range(30)],
        6: [start],
        7: [start + 60_000 * i for i in range(200)] + [start + 60_000 * 100] * 25,
        8: [rng.randrange(start, start + 40_000) for _ in range(400)]
        + [start + 900_000_000 + rng.randrange(40_000) for _ in range(100)],
    }


def frame(spark, devices):
    rows = [(d, int(t)) for d, times in devices.items() for t in times]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "id int, eventtime long")


@pytest.mark.parametrize(
    "limit,cooldown,slice_ms", [(7, 5_000, 20_000), (1, 1, 60_000), (20, 61_000, 3_600_000), (100, 600_000, 600_000), (9, 700_000, 60_000)]
)
@pytest.mark.parametrize("leaf_times", [1, 70, 4096])
def test_slices_follow_the_rule(spark, limit, cooldown, slice_ms, leaf_times):
    devices = patterns(limit)
    expected = sorted((d, t) for d, times in devices.items() for t in replay(times, limit, cooldown))
    events = frame(spark, devices).persist()
    got = collection_triggers(events, limit, cooldown, slice_ms, leaf_times)
    assert sorted((r.id, r.eventtime) for r in got.collect()) == expected
    events.unpersist()


def test_no_events(spark):
    assert collection_triggers(spark.createDataFrame([], "id int, eventtime long"), 3, 10, 1_000).count() == 0


def test_live_settings(spark):
    """100 events at two per second: first trigger at the 100th, the next one a pause later."""
    times = [1_700_000_000_000 + 500 * i for i in range(2_700)]
    hits = [r.eventtime for r in collection_triggers(frame(spark, {9: times}), 100, 600_000, 3_600_000).collect()]
    assert sorted(hits) == [times[99], times[99 + 1200 + 99], times[99 + 2 * (1200 + 99)]]


def test_slice_exits_match_a_walk():
    from vigil.operators.trigger import COUNTING, Slice

    rng = np.random.default_rng(5)
    times = np.unique(rng.integers(0, 5_000, 400))
    part = Slice(times, rng.integers(1, 4, len(times)), 6, 130)
    ends, counts = part.exits()
    for p in range(len(times)):
        seen, pause_end = 0, COUNTING
        for t, n in zip(times[p:], np.diff(np.concatenate([[0], part.total]))[p:]):
            if pause_end != COUNTING and t < pause_end:
                continue
            pause_end = COUNTING
            seen += n
            if seen >= 6:
                seen, pause_end = 0, t + 130
        if pause_end != COUNTING:
            assert (ends[p], counts[p]) == (pause_end, 0)
        else:
            assert (ends[p], counts[p]) == (COUNTING, seen)


def test_limits_must_be_positive(spark):
    with pytest.raises(ValueError):
        collection_triggers(frame(spark, {1: [1]}), 0, 1, 1)
