"""Tables of the engine as plain Parquet folders.

Every micro-batch writes a folder of its own, `writer=<name>/batch_id=<n>/attempt=<a>`; of a batch that a restart
writes again the newest complete attempt counts, so that no row is repeated or lost. From time to time the batches
so far are folded into one folder, and a small pointer file then says which folders stand for them. No folder is
written twice; what a fold has replaced stays until readers have had time to end. Readers see the latest value per key.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.config import HOUR_MS
from vigil.operators.ordered import latest_rows
from vigil.operators.upsert import merge_log
from vigil.sources.files import Folder

FOLDED = "folded"  # the writer of folds; its rows come before those of all other batches


@dataclass(frozen=True)
class BatchLog:
    """Append-only table."""

    path: str
    schema: T.StructType

    def append(self, rows: DataFrame, writer: str, batch_id: int) -> None:
        self._write(rows, writer, batch_id)

    def read_batch(self, spark: SparkSession, writer: str, batch_id: int) -> DataFrame:
        return self._load(spark, [b for b in self._newest(spark) if b[:2] == (writer, batch_id)]).select(
            *self.schema.names)

    def read_log(self, spark: SparkSession) -> DataFrame:
        return self._load(spark, self._live(spark, self._pointer(spark)))

    def read(self, spark: SparkSession) -> DataFrame:
        return self.read_log(spark).select(*self.schema.names)

    def fold(self, spark: SparkSession, fan: int = 8, grace_ms: int = HOUR_MS) -> None:
        """Fold the batches since the last fold into one folder; to be called by one process at a time.

        The newest batch of each writer stays, as a restart may write it again. `fan` folds of a size become one,
        like the digits of a number, so that there are few and a row is written anew only now and then. What a fold
        has replaced is removed by a later one, when readers have had `grace_ms` to end."""
        before = self._pointer(spark)
        number = before["number"] + 1
        folded, tier = list(before["folds"]), 0
        batches = [b for b in self._live(spark, before) if b[0] != FOLDED]
        newest = {writer: max(b[1] for b in batches if b[0] == writer) for writer, *_ in batches}
        batches = [b for b in batches if b[1] < newest[b[0]]]
        if not batches:
            return
        taken = []
        while [t for _, t in folded[-(fan - 1):]] == [tier] * (fan - 1):
            taken, folded, tier = folded[-(fan - 1):] + taken, folded[: -(fan - 1)], tier + 1
        old = {n for n, _ in taken}
        log = self._load(spark, batches + [b for b in self._newest(spark) if b[0] == FOLDED and b[1] in old])
        self._write(self._merged(log), FOLDED, number)
        upto = before["upto"] | {w: max(b[1] for b in batches if b[0] == w) for w in {b[0] for b in batches}}
        folder = Folder(spark, self.path)
        pointer = {"number": number, "folds": [*folded, [number, tier]], "upto": upto, "at": time.time_ns() // 1_000_000}
        folder.create(f"_folds/{number:010d}", json.dumps(pointer))
        old = [p for p in self._pointers(folder)[:-1] if p["at"] <= pointer["at"] - grace_ms]
        if old:
            self._forget(folder, old[-1])

    def _forget(self, folder: Folder, pointer: dict) -> None:
        """Remove what was already replaced when `pointer` was the newest."""
        keep = {n for n, _ in pointer["folds"]}
        for name in folder.matching("writer=*/batch_id=*"):
            writer, batch_id = (part.split("=", 1)[1] for part in name.split("/"))
            n = int(batch_id)
            if n <= pointer["number"] and n not in keep if writer == FOLDED else n <= pointer["upto"].get(writer, n - 1):
                folder.remove(name)
        for name in folder.matching("_folds/*"):
            if int(name.split("/")[1]) < pointer["number"]:
                folder.remove(name)

    @staticmethod
    def _pointers(folder: Folder, last: int = 0) -> list[dict]:
        names = sorted(n for n in folder.matching("_folds/*") if n.rsplit("/", 1)[1].isdigit())
        return [json.loads(folder.read(n)) for n in names[-last:]]

    def _pointer(self, spark: SparkSession) -> dict:
        return next(iter(self._pointers(Folder(spark, self.path), 1)), {"number": 0, "folds": [], "upto": {}})

    def _newest(self, spark: SparkSession) -> list[tuple[str, int, int]]:
        """(writer, batch, attempt) of the newest complete attempt of every batch."""
        found: dict[tuple[str, int], int] = {}
        for name in Folder(spark, self.path).matching("writer=*/batch_id=*/attempt=*/_SUCCESS"):
            writer, batch_id, attempt = (part.split("=", 1)[1] for part in name.split("/")[:3])
            key = writer, int(batch_id)
            found[key] = max(found.get(key, 0), int(attempt))
        return sorted((*key, attempt) for key, attempt in found.items())

    def _live(self, spark: SparkSession, pointer: dict) -> list[tuple[str, int, int]]:
        folds = {n for n, _ in pointer["folds"]}
        return [b for b in self._newest(spark)
                if (b[1] in folds if b[0] == FOLDED else b[1] > pointer["upto"].get(b[0], b[1] - 1))]

    def _load(self, spark: SparkSession, batches: list[tuple[str, int, int]]) -> DataFrame:
        stored = T.StructType([
            *self.schema.fields, T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType()),
            *self._extra(),
        ])
        paths = [f"{self.path}/writer={w}/batch_id={b}/attempt={a}" for w, b, a in batches]
        if not paths:
            return spark.createDataFrame([], stored)
        return spark.read.schema(stored).option("basePath", self.path).parquet(*paths).select(*stored.names)

    def _merged(self, log: DataFrame) -> DataFrame:
        """What is left of rows of the log when they are folded."""
        return log.select(*self.schema.names)

    def _extra(self):
        return []

    def _write(self, rows: DataFrame, writer: str, batch_id: int) -> None:
        target = f"writer={writer}/batch_id={batch_id}"
        tries = Folder(rows.sparkSession, self.path).matching(f"{target}/attempt=*")
        attempt = 1 + max((int(t.rsplit("=", 1)[1]) for t in tries), default=0)
        self._placed(rows).parquet(f"{self.path}/{target}/attempt={attempt}")

    def _placed(self, rows: DataFrame):
        return rows.write


@dataclass(frozen=True)
class KeyedTable(BatchLog):
    """Table with a primary key; a write sets the columns it carries and leaves the others.

    Rows are spread over `buckets` folders by the hash of the leading key, so a read for a few keys
    prunes to their folders, and are sorted by key and newest first inside each file.
    """

    keys: tuple[str, ...]
    buckets: int = 16
    first_wins: bool = False
    #: The column that says which of two rows of a key is the later; else a later batch, and in it the greater row.
    order: str | None = None

    def append(self, rows: DataFrame, writer: str, batch_id: int) -> None:
        columns = [c for c in self.schema.names if c in rows.columns]
        values = [c for c in columns if c not in self.keys]
        # One row per key and batch, so that the batch number settles every later comparison.
        best = F.min if self.first_wins else F.max
        if len(values) == 1:
            single = rows.groupBy(*self.keys).agg(best(values[0]).alias(values[0]))
        else:
            values.sort(key=lambda c: c != self.order)
            single = rows.groupBy(*self.keys).agg(best(F.struct(*values)).alias("_v")).select(*self.keys, "_v.*")
        self._write(self._kept(single.select(
            *[F.col(f.name).cast(f.dataType) for f in self.schema if f.name in columns])), writer, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._merged(self.read_log(spark))

    def read_keys(self, spark: SparkSession, wanted: DataFrame) -> DataFrame:
        """Rows of the leading keys in `wanted`; buckets without any of them are not read."""
        marked = wanted.select(self.keys[0], self._bucket().alias("bucket"))
        # At most `buckets` numbers come to the driver.
        needed = [row["bucket"] for row in marked.select("bucket").distinct().collect()]
        log = self.read_log(spark).filter(F.col("bucket").isin(needed))
        return self._merged(log.join(marked, ["bucket", self.keys[0]], "left_semi"))

    def compact_into(self, spark: SparkSession, path: str) -> KeyedTable:
        """The current rows as one batch of a new table; later batches of the old one may follow it."""
        target = replace(self, path=path)
        target.append(self.read(spark), "compaction", -1)
        return target

    def _kept(self, rows: DataFrame) -> DataFrame:
        """What is kept of the rows of a batch or a fold, one for each key."""
        return rows

    def _placed(self, rows: DataFrame):
        # Rebalancing lets adaptive execution split a hot bucket and join small ones.
        placed = rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        order = [F.col("bucket"), F.col(self.keys[0]), *[F.col(k).desc() for k in self.keys[1:]]]
        return placed.sortWithinPartitions(*order).write.partitionBy("bucket")

    def _bucket(self):
        return F.pmod(F.hash(self.keys[0]), F.lit(self.buckets))

    def _extra(self):
        return [T.StructField("bucket", T.IntegerType())]

    def _merged(self, log: DataFrame) -> DataFrame:
        batch = F.struct((F.col("writer") != FOLDED).alias("later"), "batch_id", "writer")
        order = F.struct(self.order, batch.alias("batch")) if self.order else batch
        writes = log.select(*self.schema.names, order.alias("_order"))
        return self._kept(merge_log(writes, list(self.keys), "_order", self.first_wins).select(*self.schema.names))


@dataclass(frozen=True)
class LatestTable(KeyedTable):
    """The newest `limit` rows of every leading key by the second, kept so batch by batch.

    Each batch and each fold is cut to its own newest rows, so that neither the table nor a read of it grows with
    the history. A row that is cut has `limit` newer ones of its key in the same folder, so it is never missed.
    """

    limit: int = 300
    salts: int = 32

    def _kept(self, rows: DataFrame) -> DataFrame:
        return latest_rows(rows, *self.keys, self.limit, self.salts).select(*rows.columns)
