import pytest

from __spark_entry__ import entry, oracle_sql, queries
from vigil.plans.queries import QUERIES
from compare import connect, oracle_rows, rows_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    columns, rows = rows_of(queries()[name](spark, SF))
    expected_columns, expected = oracle_rows(con, oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


def test_known_counts(spark):
    assert queries()["collection_triggers"](spark, SF).count() == 334
    assert queries()["anomalies"](spark, SF).count() == 41
    assert queries()["score_events_asof"](spark, SF).filter("distance > 3.0").count() == 222


def test_entry(spark):
    assert entry(spark).columns == ["id", "eventtime", "notified_at", "value", "base"]
    entry(spark).count()
