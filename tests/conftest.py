import pytest

from harvestry.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", spark__sql__adaptive__coalescePartitions__enabled="true")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def one(spark):
    """one(column) is the value of an expression without input."""

    def run(column):
        return spark.range(1).select(column.alias("x")).first()["x"]

    return run
