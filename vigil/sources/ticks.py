"""A streaming source of ticks: the times at which something is to be done again, for as long as the query runs.

The offset is the next tick, kept in the query's checkpoint, so that a restart goes on where the last batch ended:
no tick is lost or repeated, and those of a pause come at once.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

PART_TICKS = 100_000  # at most so many ticks of a batch in a task


@dataclass
class TickRange(InputPartition):
    first: int
    end: int


class TickReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.every = int(options["every_ms"])
        self.first = int(options.get("first_ms") or 0) or None
        self.last = int(options.get("last_ms") or 0) or None

    def initialOffset(self) -> dict:
        first = _now_ms() if self.first is None else self.first
        return {"next": first // self.every * self.every}

    def latestOffset(self) -> dict:
        last = _now_ms() if self.last is None else min(self.last, _now_ms())
        return {"next": (last // self.every + 1) * self.every}

    def partitions(self, start: dict, end: dict) -> list[TickRange]:
        step = PART_TICKS * self.every
        return [TickRange(at, min(at + step, end["next"])) for at in range(start["next"], end["next"], step)]

    def read(self, partition: TickRange) -> Iterator[pa.RecordBatch]:
        ticks = np.arange(partition.first, partition.end, self.every, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ticks)], ["tick"])

    def commit(self, end: dict) -> None:
        pass


class TickSource(DataSource):
    """Options: every_ms; first_ms, else ticks begin with the query; last_ms, else they never end."""

    @classmethod
    def name(cls) -> str:
        return "ticks"

    def schema(self) -> str:
        return "tick bigint"

    def streamReader(self, schema) -> TickReader:
        return TickReader(self.options)


def _now_ms() -> int:
    return time.time_ns() // 1_000_000


def read_ticks(spark: SparkSession, every_ms: int, first_ms: int | None = None, last_ms: int | None = None) -> DataFrame:
    """A stream of `tick`: the multiples of `every_ms` from that at or before `first_ms` on, each when its time has come."""
    spark.dataSource.register(TickSource)
    reader = spark.readStream.format("ticks").option("every_ms", every_ms)
    for name, value in (("first_ms", first_ms), ("last_ms", last_ms)):
        reader = reader if value is None else reader.option(name, value)
    return reader.load()
