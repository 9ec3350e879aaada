"""The fixture that the tests of this folder share."""

import pytest


@pytest.fixture()
def table(spark):
    """A small DataFrame from a schema and rows, over several partitions."""
    def make(schema, rows, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
