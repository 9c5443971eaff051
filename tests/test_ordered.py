import random

import pytest

from vigil.operators.ordered import as_of, history_before, latest_rows


def readings(seed, devices=6, most=120):
    rng = random.Random(seed)
    return [
        (d, t, rng.randrange(-50, 50))
        for d in range(devices)
        for t in rng.sample(range(1_000), rng.randrange(1, most))
    ]


@pytest.mark.parametrize("limit,slice_ms", [(1, 10), (5, 37), (30, 200), (300, 5_000)])
def test_history_before_equals_a_scan(spark, limit, slice_ms):
    rng = random.Random(limit)
    rows = readings(limit)
    cuts = [(rng.randrange(8), rng.randrange(-20, 1_100)) for _ in range(60)]
    cuts += [(d, t) for d, t, _ in rng.sample(rows, 20)]
    expected = set()
    for device, cut in set(cuts):
        past = sorted(((t, v) for d, t, v in rows if d == device and t <= cut), reverse=True)[:limit]
        expected |= {(device, cut, i + 1, t, v) for i, (t, v) in enumerate(past)}
    got = history_before(
        spark.createDataFrame(rows, "id int, t long, v int"), spark.createDataFrame(cuts, "id int, cut long"),
        "id", "t", "cut", limit, slice_ms,
    ).collect()
    assert len(got) == len(expected)
    assert {(r.id, r.cut, r.rn, r.t, r.v) for r in got} == expected


@pytest.mark.parametrize("slice_ms", [7, 100, 10_000])
def test_as_of_equals_a_scan(spark, slice_ms):
    rng = random.Random(slice_ms)
    events = readings(slice_ms)
    versions = [(d, s, f"{d}-{s}") for d in range(5) for s in rng.sample(range(-50, 1_000), rng.randrange(0, 12))]
    expected = sorted(
        (d, t, max(((s, m) for i, s, m in versions if i == d and s <= t), default=(None, None))[1] or "")
        for d, t, _ in events
    )
    got = as_of(
        spark.createDataFrame(events, "id int, t long, v int"),
        spark.createDataFrame(versions, "id int, since long, m string"), "id", "t", "since", slice_ms,
    ).collect()
    assert sorted((r.id, r.t, r.m or "") for r in got) == expected


def test_latest_rows_ignores_input_order_and_salts(spark):
    rows = readings(1)
    expected = sorted(
        (d, i + 1, t)
        for d in {r[0] for r in rows}
        for i, t in enumerate(sorted((t for x, t, _ in rows if x == d), reverse=True)[:10])
    )
    for salts in (1, 3, 16):
        random.Random(salts).shuffle(rows)
        got = latest_rows(spark.createDataFrame(rows, "id int, t long, v int"), "id", "t", 10, salts)
        assert sorted((r.id, r.rn, r.t) for r in got.collect()) == expected


def test_hot_device_goes_through_many_tasks(spark):
    """One device holds nearly all rows; its history still lands in several slices and blocks."""
    rows = [(1, t, t % 7) for t in range(3_000)] + [(2, 5, 1)]
    got = history_before(
        spark.createDataFrame(rows, "id int, t long, v int"), spark.createDataFrame([(1, 2_500), (2, 9)], "id int, cut long"),
        "id", "t", "cut", 300, 100,
    )
    times = sorted(r.t for r in got.collect() if r.id == 1)
    assert times == list(range(2_201, 2_501))
