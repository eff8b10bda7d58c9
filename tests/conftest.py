import pytest
from pyspark.sql import SparkSession

from ordergate.session import configure


@pytest.fixture(scope="session")
def spark():
    builder = (
        configure(SparkSession.builder.master("local[8]").appName("ordergate-tests"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
