"""The whole chain on hand-made messages against a plain replay, event by event."""

import json
import math
import random

from vigil.config import Settings
from vigil.functions.codec import decode_messages
from vigil.plans import stages

SETTINGS = Settings(trigger_limit=6, cooldown_ms=4_000, history_limit=8, chunk_rows=3, refresh_ms=1_500, slice_ms=7_000)


def sample():
    rng = random.Random(11)
    messages = []
    # Device 1 owns most of the stream and goes the way of large devices.
    for device, events in ((1, 300), (2, 30), (3, 25), (4, 3)):
        for t in sorted(rng.sample(range(60_000), events)):
            odd = 5 if rng.random() < 0.05 else 1
            messages.append((device, 1_700_000_000_000 + t, rng.randrange(-7, 8), odd, 110 + device))
    return messages


def replay(messages):
    alerts, distances = set(), {}
    for device in {m[0] for m in messages}:
        history, versions, seen, pause_end = [], [], 0, None
        for _, t, variation, odd, base in sorted(m for m in messages if m[0] == device):
            value = (float(base) if odd == 1 else base * 1.1) + variation
            bp = math.trunc(value)
            visible = [m for effective, m in versions if effective <= t]
            distance = 0.0
            if visible:
                n, s, ss = visible[-1]
                width = n * ss - s * s
                distance = abs(bp * n - s) / math.sqrt(width) if width else (0.0 if bp * n == s else math.inf)
            distances[device, t] = distance
            if distance > 3.0:
                alerts.add((device, t, value))
            history.append(bp)
            if pause_end is not None and t < pause_end:
                continue
            seen += 1
            if seen >= SETTINGS.trigger_limit:
                seen, pause_end = 0, t + SETTINGS.cooldown_ms
                last = history[-SETTINGS.history_limit :]
                effective = (t // SETTINGS.refresh_ms + 1) * SETTINGS.refresh_ms
                versions.append((effective, (len(last), sum(last), sum(v * v for v in last))))
    return alerts, distances


def frame(spark, messages):
    texts = [
        (bytearray(json.dumps({"source": {"id": d, "base": b}, "eventtime": t, "variation": v, "isanomaly": a}), "utf-8"),)
        for d, t, v, a, b in messages
    ]
    return spark.createDataFrame(texts, "data binary")


def test_chain_equals_replay_in_any_order(spark):
    messages = sample()
    expected_alerts, expected = replay(messages)
    assert expected_alerts
    for seed in (1, 2):
        random.Random(seed).shuffle(messages)
        raw = frame(spark, messages).repartition(5)
        events = decode_messages(raw)
        versions = stages.train_models(stages.count_and_collect_events(events, SETTINGS))
        scores = stages.calculate_distances(events, versions, SETTINGS).collect()
        assert {(r.id, r.eventtime): r.distance for r in scores} == expected
        assert len(scores) == len(expected)
        alerts = stages.alerts_from_messages(raw, SETTINGS).selectExpr("id", "unix_millis(eventtime) t", "value").collect()
        assert {tuple(r) for r in alerts} == expected_alerts and len(alerts) == len(expected_alerts)
