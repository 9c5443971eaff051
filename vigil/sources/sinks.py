"""Sinks for one micro-batch: keyed upserts, appends, JDBC and lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from vigil.sources.tables import BatchLog, KeyedTable

Projection = Callable[[DataFrame], DataFrame]
BatchSink = Callable[[DataFrame, int], None]


def keyed_sink(table: KeyedTable, writer: str, projection: Projection | None = None) -> BatchSink:
    """Upsert the columns that `projection` yields."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.append(projection(batch) if projection else batch, writer, batch_id)

    return write


def append_sink(table: BatchLog, writer: str, projection: Projection | None = None) -> BatchSink:
    def write(batch: DataFrame, batch_id: int) -> None:
        table.append(projection(batch) if projection else batch, writer, batch_id)

    return write


def jdbc_alert_sink(url: str, table: str, known: Callable[[], DataFrame], **options: str) -> BatchSink:
    """Insert the rows of `to_alerts` that the target does not hold yet, so that a replay repeats none.

    `known` gives the target's present (id, eventtime) keys; `notified_at` is left to its default.
    """

    def write(alerts: DataFrame, batch_id: int) -> None:
        fresh = alerts.select("id", "eventtime", "value", "base").join(known(), ["id", "eventtime"], "left_anti")
        fresh.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()

    return write


def line_sink(lines: BatchLog, writer: str, projection: Projection) -> BatchSink:
    """Append the lines that `projection` makes to a table of (id, line): all of them, by the tasks that hold
    the rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        lines.append(projection(batch).select("id", "line"), writer, batch_id)

    return write
