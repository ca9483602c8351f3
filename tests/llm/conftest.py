from __future__ import annotations

import pytest

CLASH = "extra long"


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame from rows and a schema, spread over a few partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
