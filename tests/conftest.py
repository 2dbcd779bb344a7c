import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("rawstrata-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", "/tmp/rawstrata-test-warehouse")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            ("Ada", "Lovelace", 36),
            ("Alan", "Turing", 41),
            ("Grace", "Hopper", 85),
            ("Edsger", None, 72),
        ],
        "first_name string, last_name string, age bigint",
    )


@pytest.fixture
def quality_frame(spark):
    """Builds the three columns the quality counts look at."""

    def build(rows):
        return spark.createDataFrame(
            rows, "source_record_id string, _corrupt_record string, _record_hash string"
        )

    return build
