import pytest


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="session")
def make(spark):
    """make("a long, b string", [...]) -> DataFrame."""
    return lambda schema, data: spark.createDataFrame(data, schema)
