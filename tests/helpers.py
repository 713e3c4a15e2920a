"""Small message and table builders."""

from __future__ import annotations

import json
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.spec import RAW_SCHEMA, TOPIC_SCHEMA


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def micros(text: str) -> int:
    return (utc(text) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def message(id: int | None, op: str | None, **fields) -> str:
    body = {"id": id, **fields}
    if op is not None:
        body["__op"] = op
    return json.dumps(body)


def record(partition: int, offset: int, key: str | None, text: str | None, at: str = "2025-01-01 00:00:00"):
    return (partition, offset, key, text, utc(at))


def raw_df(spark: SparkSession, *records) -> DataFrame:
    return spark.createDataFrame(list(records), RAW_SCHEMA)


def topic_df(spark: SparkSession, *records) -> DataFrame:
    raw = raw_df(spark, *records)
    return raw.select(
        F.col("key").cast("binary").alias("key"),
        F.col("message").cast("binary").alias("value"),
        F.lit("users").alias("topic"),
        "partition",
        "offset",
        F.col("kafka_timestamp").alias("timestamp"),
    ).select(*[c.split()[0] for c in TOPIC_SCHEMA.split(", ")])


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def key(id: int) -> str:
    return json.dumps({"id": id})


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def pushed_filters(df: DataFrame) -> str:
    """The formatted plan, whose lists of pushed filters are not cut."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
