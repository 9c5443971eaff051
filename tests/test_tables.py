import tempfile

import pytest
from pyspark.sql import functions as F

from vigil.schemas import LATEST_READING, LINE, READING
from vigil.sources.files import Folder
from vigil.sources.tables import FOLDED, BatchLog, KeyedTable, LatestTable


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t"


def batch(spark, rows, names="device_id int, eventtime long, value int"):
    return spark.createDataFrame(rows, names)


def state(table, spark):
    return {(r.device_id, r.eventtime): r.value for r in table.read(spark).collect()}


def test_folds_keep_the_latest_values_and_few_folders(spark, path):
    table = KeyedTable(path, READING, ("device_id", "eventtime"), 2)
    expected, held = {}, None
    for n in range(14):
        rows = [(d, t, 100 * n + t) for d in (1, 2) for t in range(n, n + 3)]
        table.append(batch(spark, rows), "values", n)
        expected |= {(d, t): v for d, t, v in rows}
        if n == 9:
            held = table.read(spark), dict(expected)
        if n % 2:
            table.fold(spark, fan=2, grace_ms=0)
            assert state(table, spark) == expected
        if n == 10:  # a reader that began before a fold still has all its files
            assert {(r.device_id, r.eventtime): r.value for r in held[0].collect()} == held[1]
    assert len(Folder(spark, path).matching("writer=*/batch_id=*")) <= 10
    assert len(Folder(spark, path).matching("_folds/*")) == 2
    assert {w for w, *_ in table._newest(spark)} == {"values", FOLDED}


def test_the_newest_complete_attempt_counts(spark, path):
    table = BatchLog(path, LINE)
    for text in ("first", "second"):
        table.append(batch(spark, [(1, text)], "id int, line string"), "w", 3)
    assert [r.line for r in table.read(spark).collect()] == ["second"]
    folder = Folder(spark, path)
    folder.create("writer=w/batch_id=3/attempt=3/part-0.parquet", "cut short")
    assert [r.line for r in table.read_batch(spark, "w", 3).collect()] == ["second"]
    table.append(batch(spark, [(1, "next")], "id int, line string"), "w", 4)
    table.fold(spark)
    assert sorted(r.line for r in table.read(spark).collect()) == ["next", "second"]
    with pytest.raises(Exception, match="already exists"):
        folder.create("_folds/0000000001", "{}")


def test_latest_rows_stay_bounded(spark, path):
    table = LatestTable(path, LATEST_READING, ("device_id", "eventtime"), 2, limit=3, salts=2)
    seen = {}
    for n in range(6):
        rows = [(1, t, t + n) for t in range(50 * n, 50 * n + 60)] + [(2, n, n)] + [(3, -n, n)]
        table.append(batch(spark, rows), "values", n)
        seen |= {(d, t): v for d, t, v in rows}
        if n % 3 == 2:
            table.fold(spark, grace_ms=0 if n < 4 else 60_000)
        wanted = {k: seen[k] for d in (1, 2, 3) for k in sorted((k for k in seen if k[0] == d), reverse=True)[:3]}
        assert state(table, spark) == wanted
        assert table.read_log(spark).groupBy("device_id", "writer", "batch_id").count().agg(F.max("count")).first()[0] <= 3
    only = table.read_keys(spark, batch(spark, [(2,)], "device_id int"))
    assert {r.device_id for r in only.collect()} == {2} and only.count() == 3
