"""Session set-up and the shared folder that jobs write their intermediate tables to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "rowtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: epoch conversions and zone-less ISO text mean UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def pinned(df: DataFrame) -> DataFrame:
    """A table computed once and kept in the plan. Only for tables whose row count is bounded by
    the number of topic partitions or tasks, not by the data: its rows pass the driver."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``, which all
    executors must see. There is no other: a machine-local folder would lose what is in it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return shared.rstrip("/")


_scratch: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def discard_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables this process has made. Call it when a job is done and nothing
    that was read from them is used any more."""
    while _scratch:
        delete_path(spark, _scratch.pop())


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, from the working directory if it is relative."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return str(where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString())


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a directory in place of another."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(target), True)
    if not files.rename(path(source), path(target)):
        raise OSError(f"cannot move {source} to {target}")
