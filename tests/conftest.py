import pytest
from pyspark.sql import SparkSession

from rinkframe.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("rinkframe-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def database(spark, request):
    """Fresh database of this test."""
    name = "db_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    spark.sql(f"CREATE DATABASE {name}")
    return name
