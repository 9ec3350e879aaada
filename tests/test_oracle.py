"""Every registered query next to its SQL on the smallest tables; ``tests/compare.py`` does the same at any scale factor."""

import pytest
from compare import DATA, connect, difference

import __spark_entry__ as entry_points
from quadrat.queries import ORACLES

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="shared tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect("sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = entry_points.queries()[name](spark, str(DATA / "sf0.001"))
    assert difference(df, con, entry_points.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["year", *[f"bin{i}" for i in range(1, 9)]]
