"""Questions asked about a running capture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def backlog(changelog: DataFrame) -> DataFrame:
    """Row counts of sent and waiting changes."""
    return changelog.groupBy("processed").agg(F.count("*").alias("n"))


def recent_changes(changelog: DataFrame, n: int = 10, by: str = "changed_at") -> DataFrame:
    """The newest ``n`` changes, by time or by ``change_id``."""
    order = [by] if by == "change_id" else [by, "change_id"]
    return changelog.orderBy(*[F.desc(c) for c in order]).limit(n)


def by_recency(table: DataFrame, updated: str, key: str) -> DataFrame:
    """A whole table, newest update first: a range-partitioned sort."""
    return table.orderBy(F.desc(updated), key)


def op_mix(parsed: DataFrame) -> DataFrame:
    """Number of messages, keys' first and last time per partition and operation."""
    return parsed.groupBy("partition", "__op").agg(
        F.count("*").alias("n"),
        F.min("kafka_timestamp").alias("first_at"),
        F.max("kafka_timestamp").alias("last_at"),
    )


def peek(topic: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` messages of a topic."""
    return topic.orderBy("partition", "offset").limit(n)


def capture_lag(parsed: DataFrame, every: str = "1 hour", delay: str | None = None) -> DataFrame:
    """How long changes take from their source to the topic, in milliseconds, by windows of the topic's time: ``n``
    changes, ``p50``, ``p95``, ``p99`` and ``most``. Records without a source time are not counted.

    Percentiles are sketches that tasks send summed up. A stream needs ``delay``, how late records may come.
    """
    lag = F.unix_millis("kafka_timestamp") - F.col("__source_ts_ms")
    rows = parsed.select("kafka_timestamp", lag.alias("lag")).filter("lag IS NOT NULL")
    if delay:
        rows = rows.withWatermark("kafka_timestamp", delay)
    found = rows.groupBy(F.window("kafka_timestamp", every).alias("w")).agg(
        F.count("*").alias("n"), F.percentile_approx("lag", [0.5, 0.95, 0.99]).alias("p"), F.max("lag").alias("most")
    )
    return found.select(
        F.col("w.start").alias("start"), "n", *[F.col("p")[i].alias(x) for i, x in enumerate(("p50", "p95", "p99"))], "most"
    )
