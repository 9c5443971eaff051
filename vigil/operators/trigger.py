"""When to retrain: every `limit`-th event of a device, with a pause after each trigger.

Replay rule: take a device's events in time order and count; the event that brings the count to
`limit` is a trigger at its time T; events before T + cooldown are ignored; then the count starts
again at zero.

The rule is sequential, but what a stretch of time needs to know from its past is small: how far the
count had come, or when the pause ends. So every device is cut into time slices, neighbours with few events
are put together, and each such leaf becomes, by itself, a table "state on entry -> state on exit". Tables
of neighbouring leaves are merged in rounds up a tree, and the known first state is then handed down it. A
row holds one leaf, or `FAN` tables of at most limit + cooldown + 1 entries, whatever the number of events
of a device; one Python call takes many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.numeric import SLICE, own_slice, with_slice
from vigil.session import materialize

FAN = 8
COUNTING = np.iinfo(np.int64).min  # `pause_end` of a state that is counting, not pausing

NODE = "id int, node bigint, table binary"
ENTRY = "id int, node bigint, pause_end bigint, count bigint"


class Slice:
    """Distinct times with their event counts, walked by binary search."""

    def __init__(self, times, counts, limit, cooldown):
        self.times = times
        self.total = np.cumsum(counts)
        self.limit = limit
        self.cooldown = cooldown

    def hit(self, first, already):
        """Position of the event that completes the count begun at `first` with `already` seen."""
        before = np.where(first > 0, self.total[np.maximum(first, 1) - 1], 0)
        return np.searchsorted(self.total, before + self.limit - already)

    def resume(self, pause_end):
        return np.searchsorted(self.times, pause_end)

    def exits(self):
        """State on exit when the count starts at zero at position p, for p = 0..n."""
        n = len(self.times)
        first = np.arange(n)
        hit = self.hit(first, 0)
        fires = hit < n
        pause_end = np.full(n, COUNTING)
        pause_end[fires] = self.times[hit[fires]] + self.cooldown
        left_over = self.total[-1] - np.where(first > 0, self.total[np.maximum(first, 1) - 1], 0)
        out_end = np.append(pause_end, COUNTING)
        out_count = np.append(np.where(fires, 0, left_over), 0)
        # Follow the restarts inside the slice to the last one, doubling the stride.
        here = np.arange(n + 1)
        after = np.append(np.where(fires, self.resume(pause_end), n), n)
        last = np.where(after < n, after, here)
        while True:
            further = last[last]
            if np.array_equal(further, last):
                return out_end[last], out_count[last]
            last = further

    def table(self) -> Table:
        n = len(self.times)
        exit_end, exit_count = self.exits()
        seen = np.arange(self.limit, dtype=np.int64)
        hit = self.hit(np.zeros(self.limit, dtype=np.int64), seen)
        fires = hit < n
        pause = self.times[np.where(fires, hit, 0)] + self.cooldown
        back = np.minimum(self.resume(pause), n)
        stays = fires & (back < n)
        end = np.where(stays, exit_end[back], np.where(fires, pause, COUNTING))
        count = np.where(stays, exit_count[back], np.where(fires, 0, seen + self.total[-1]))
        # A pause began before the first event, so it ends within one cooldown of it.
        reach = min(int(self.resume(self.times[0] + self.cooldown)) + 1, n)
        return Table(self.times[0], self.times[-1], end, count, self.times[:reach], exit_end[:reach], exit_count[:reach])

    def walk(self, pause_end, count):
        """Times of the triggers in this slice, from one state on entry."""
        hits = []
        first = int(self.resume(pause_end)) if pause_end != COUNTING else 0
        while first < len(self.times):
            hit = int(self.hit(np.int64(first), count))
            if hit >= len(self.times):
                break
            hits.append(int(self.times[hit]))
            count = 0
            first = int(self.resume(self.times[hit] + self.cooldown))
        return hits


class Table:
    """States on exit of a stretch of events from `first` to `last`, by the state on entry.

    `end`, `count`: when the count stood at 0, 1, ... on entry. `key_end`, `key_count`: when a pause is over
    in time for the event at `keys`. A pause that outlasts the stretch leaves it as it came.
    """

    def __init__(self, first, last, end, count, keys, key_end, key_count):
        self.first, self.last = int(first), int(last)
        self.end, self.count = end, count
        self.keys, self.key_end, self.key_count = keys, key_end, key_count

    def leave(self, end, count):
        at_key = np.minimum(np.searchsorted(self.keys, end), len(self.keys) - 1)
        counting = end == COUNTING
        at_count = np.where(counting, count, 0)
        beyond = ~counting & (end > self.last)
        return (
            np.where(counting, self.end[at_count], np.where(beyond, end, self.key_end[at_key])),
            np.where(counting, self.count[at_count], np.where(beyond, 0, self.key_count[at_key])),
        )

    def dump(self) -> bytes:
        head = [self.first, self.last, len(self.end), len(self.keys)]
        parts = (head, self.end, self.count, self.keys, self.key_end, self.key_count)
        return np.concatenate([np.asarray(p, dtype=np.int64) for p in parts]).tobytes()

    @staticmethod
    def load(data: bytes) -> Table:
        numbers = np.frombuffer(data, dtype=np.int64)
        first, last, limit, keys = numbers[:4].tolist()
        ends = np.cumsum([limit, limit, keys, keys])
        return Table(first, last, *np.split(numbers[4:], ends))

    @staticmethod
    def merged(tables: list[Table], cooldown: int) -> Table:
        """The table of neighbouring stretches, given in time order."""
        first = tables[0].first
        rows = [(tables[0].end, tables[0].count)]
        keys = []
        for i, table in enumerate(tables):
            rows = [table.leave(*row) for row in rows] if i else rows
            # A pause from before `first` may end here, after the stretches before have passed it on.
            if not keys or keys[-1][-1] < first + cooldown:
                keys.append(table.keys)
                rows.append((table.key_end, table.key_count))
        (end, count), *by_key = rows
        return Table(first, tables[-1].last, end, count, np.concatenate(keys),
                     np.concatenate([r[0] for r in by_key]), np.concatenate([r[1] for r in by_key]))


def _values(column: pa.Array) -> list:
    """Lists of numbers as views of the batch's own numbers, and all else as Python values."""
    if not pa.types.is_list(column.type) or not pa.types.is_integer(column.type.value_type):
        return column.to_pylist()
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for row in zip(*map(_values, batch.columns)):
            yield dict(zip(batch.schema.names, row))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 10_000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _nodes(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    return _batches(rows, ["id", "node", "table"], [pa.int32(), pa.int64(), pa.binary()], size=64)


def _slice(row: dict, limit: int, cooldown: int) -> Slice:
    return Slice(row["times"], row["counts"], limit, cooldown)


def _leaves(counted: DataFrame, leaf_times: int) -> DataFrame:
    """(id, slice, node): neighbouring slices of a device gathered into leaves of about `leaf_times` times.

    A leaf holds less than `leaf_times` times before its last slice, so that it is bounded as slices are, and a
    device with few events is one leaf. Only the sizes of slices are ordered across a device."""
    sizes = counted.groupBy("id", SLICE).agg(F.count("*").alias("size"))
    before = Window.partitionBy("id").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    leaf = F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / F.lit(leaf_times))
    return sizes.select("id", SLICE, leaf.cast("bigint").alias("node"))


def collection_triggers(
    events: DataFrame, limit: int, cooldown_ms: int, slice_ms: int, leaf_times: int = 4096
) -> DataFrame:
    """(id, eventtime) of every trigger. The lengths of slices and leaves change no result."""
    if cooldown_ms <= 0 or limit <= 0:
        raise ValueError("limit and cooldown must be positive")
    times = with_slice(events.select(F.col("id").cast("int").alias("id"), "eventtime", *own_slice(events)), "eventtime", slice_ms)
    # Events of one millisecond act as one row with a count, combined before the shuffle.
    counted = times.groupBy("id", SLICE, "eventtime").agg(F.count("*").alias("n"))
    slices = materialize(
        counted.join(_leaves(counted, leaf_times), ["id", SLICE])
        .groupBy("id", "node").agg(F.sort_array(F.collect_list(F.struct("eventtime", "n"))).alias("rows"))
        .select("id", "node", F.col("rows.eventtime").alias("times"), F.col("rows.n").alias("counts")), "slices")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _nodes((r["id"], r["node"], _slice(r, limit, cooldown_ms).table().dump()) for r in _rows(batches))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _nodes((
            r["id"], r["parent"],
            Table.merged([Table.load(c["table"]) for c in r["children"]], cooldown_ms).dump(),
        ) for r in _rows(batches))

    def hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def states() -> Iterator[tuple]:
            for r in _rows(batches):
                end, count = np.int64(r["pause_end"]), np.int64(r["count"])
                for child in r["children"]:
                    yield r["id"], child["node"], int(end), int(count)
                    end, count = Table.load(child["table"]).leave(end, count)

        return _batches(states(), ["id", "node", "pause_end", "count"], [pa.int32(), pa.int64(), pa.int64(), pa.int64()])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = ((r["id"], t) for r in _rows(batches)
                for t in _slice(r, limit, cooldown_ms).walk(r["pause_end"], r["count"]))
        return _batches(hits, ["id", "eventtime"], [pa.int32(), pa.int64()])

    low, high = slices.agg(F.min("node"), F.max("node")).first()
    # Nodes of the next round are numbered from 0; rounds go on until every device has one node.
    tables, levels = slices.select("id", "node", "times", "counts").mapInArrow(build, NODE), []
    span, offset = (0, 0) if low is None else (high - low + 1, low)
    while span > 1:
        parent = F.floor((F.col("node") - F.lit(offset)) / F.lit(FAN)).cast("bigint")
        level = materialize(tables.groupBy("id", parent.alias("parent")).agg(
            F.sort_array(F.collect_list(F.struct("node", "table"))).alias("children")), "trigger-level")
        levels.append(level)
        tables = level.mapInArrow(merge, NODE)
        span, offset = -(-span // FAN), 0

    top = levels[-1].select("id", F.col("parent").alias("node")) if levels else slices.select("id", "node")
    states = top.select("id", "node", F.lit(COUNTING).alias("pause_end"), F.lit(0).cast("bigint").alias("count"))
    for level in reversed(levels):
        states = level.join(states.withColumnRenamed("node", "parent"), ["id", "parent"]).select(
            "id", "children", "pause_end", "count").mapInArrow(hand_down, ENTRY)
    return slices.join(states, ["id", "node"]).select("id", "times", "counts", "pause_end", "count").mapInArrow(
        walk, "id int, eventtime bigint")
