"""Many devices that share a key of the state."""

import random

import pandas as pd
import pytest
from test_panes import Run

from vigil.streaming.counter import PARTS, EventCounter, PaneCounter, count_triggers


def packed(events):
    rows = pd.DataFrame(events, columns=["id", "eventtime"]).groupby("id", sort=False)["eventtime"].agg(list)
    return pd.DataFrame({"id": rows.index, "times": rows.to_numpy()})


def replay(batches, limit, cooldown):
    """Triggers by a plain replay of one device after the other: (batch, id, eventtime)."""
    state, found = {}, []
    for n, (now, events) in enumerate(batches):
        for device in sorted({i for i, _ in events}):
            times = sorted(t for i, t in events if i == device)
            seen, until = state.get(device, (0, 0))
            if until > now:
                continue
            seen = 0 if until else seen
            if seen + len(times) >= limit:
                found.append((n, device, times[limit - seen - 1]))
                state[device] = 0, now + cooldown
            else:
                state[device] = seen + len(times), 0
    return found


@pytest.mark.parametrize("processor", [EventCounter(4, 25), PaneCounter(4, 25, 15_000, 30_000, 0)])
def test_devices_of_a_part_count_by_themselves(processor):
    rng = random.Random(5)
    batches = [(10 * n, [(rng.randrange(40), 100 * n + rng.randrange(100)) for _ in range(rng.randrange(90))])
               for n in range(1, 30)]
    run, found = Run(processor, 3), []
    for n, (now, events) in enumerate(batches):
        out = run.batch(now, 0, packed(events) if events else None)
        found += [(n, *row[:2]) for row in out if len(row) == 2 or row[2] == "trigger"]
    expected = replay(batches, 4, 25)
    assert sorted(found) == expected and len({i for _, i, _ in expected}) == 40


def test_silent_devices_are_forgotten_after_their_pause():
    run = Run(EventCounter(2, 100), 0)
    assert len(run.batch(0, 0, packed([(1, 5), (1, 6), (2, 5), (3, 7), (3, 8)]))) == 2
    run.batch(50, 0, packed([(4, 9)]))
    assert set(run.processor.counts.held) == {(1,), (2,), (3,), (4,)}
    assert run.batch(100, 0) == [] and set(run.processor.counts.held) == {(2,), (4,)} and not run.processor.pauses.held


def test_the_state_has_few_keys(spark):
    events = spark.readStream.format("rate").load().selectExpr("cast(value as int) id", "value eventtime")
    plan = count_triggers(events, 5, 1000)._jdf.queryExecution().analyzed().toString()
    keyed = [line for line in plan.splitlines() if "TransformWithState" in line]
    assert keyed and "part#" in keyed[0] and PARTS < 10_000
