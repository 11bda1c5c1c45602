import pytest


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """The operators run many small jobs; few partitions keep the tests short."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, before)
