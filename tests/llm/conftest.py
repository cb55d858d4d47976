import pytest


@pytest.fixture(autouse=True)
def no_narrow_batches(spark):
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
