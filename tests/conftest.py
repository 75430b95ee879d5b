import pytest
from pyspark.sql import SparkSession

from tests.rental_data import make_sources


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("starloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sources(spark):
    return make_sources(spark)


@pytest.fixture
def rows():
    """Sorted plain tuples of a frame."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
