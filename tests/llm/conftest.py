from __future__ import annotations

import pytest


@pytest.fixture(autouse=True)
def few_rows_at_once(spark):
    """Every Python step sees its rows in many small batches, as it would with many rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, 7)
    yield
    spark.conf.unset(key)
