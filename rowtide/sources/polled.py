"""Incremental reads of a table by its update stamp."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.sources.batches import Batches


class Watermark:
    """The newest update stamp that has been sent, as one-row versions of a control table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.values = Batches(spark, path, "last_polled timestamp")

    def get(self) -> datetime | None:
        """The saved stamp in UTC, or None before the first poll."""
        numbers = self.values.numbers()
        if not numbers:
            return None
        micros = self.values.read_one(numbers[-1]).select(F.unix_micros("last_polled")).first()[0]
        if micros is None:
            return None
        return datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=micros)

    def save(self, value: DataFrame) -> int:
        """Save a one-row ``last_polled`` table."""
        return self.values.write(value.select(F.col("last_polled").cast("timestamp")))


def in_utc(stamp: datetime) -> datetime:
    """A stamp without a zone is UTC, whatever the driver's zone."""
    return stamp.replace(tzinfo=UTC) if stamp.tzinfo is None else stamp


def poll_changes(
    table: DataFrame, last_polled: datetime | None, overlap: str | None = None, updated: str = "updated_at"
) -> DataFrame:
    """Rows updated after the watermark, which the source can filter on; all rows without one.

    ``overlap`` (an interval such as ``"5 minutes"``) reads that much again, so that rows
    committed late under an earlier stamp are found; applying a row twice changes nothing.
    """
    if last_polled is None:
        return table
    last_polled = in_utc(last_polled)
    # In the column's own type, as a cast of the column would keep the filter from the source.
    bound = F.lit(last_polled).cast(table.schema[updated].dataType)
    if overlap:
        return table.filter(F.col(updated) >= bound - F.expr(f"interval {overlap}"))
    return table.filter(F.col(updated) > bound)


def next_watermark(sent: DataFrame, last_polled: datetime | None, updated: str = "updated_at") -> DataFrame:
    """One row: the newest stamp sent, but never below the old watermark."""
    newest = F.max(F.col(updated).cast("timestamp"))
    last_polled = None if last_polled is None else in_utc(last_polled)
    return sent.agg(
        (newest if last_polled is None else F.greatest(newest, F.lit(last_polled))).alias("last_polled")
    )
