"""Reading source tables from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of Spark's JDBC reader. ``split`` is a numeric column with its lower bound, upper
    bound and number of parallel reads; without it one task reads the whole table."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    options |= {k: v for k, v in {"user": user, "password": password, "driver": driver}.items() if v}
    if split:
        column, low, high, reads = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(reads),
        }
    return options


def read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table; filters such as the poll's run in the database. Needs the driver jar."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
