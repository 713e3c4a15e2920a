import pytest
from pyspark.sql import SparkSession

from rowtide import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    spark = session.build(
        "rowtide-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__sql__shuffle__partitions="2",
        spark__default__parallelism="2",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("work")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
