"""The append-only store of landed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.operators.offsets import advance, from_points
from rowtide.session import pinned
from rowtide.sources.batches import Batches
from rowtide.sources.points import ResumePoints
from rowtide.spec import RAW_SCHEMA

SCHEMA_VERSION = 1


class RawStore:
    """Decoded records under ``<base>/version_<v>``, one directory per landing."""

    def __init__(self, spark: SparkSession, base: str, version: int = SCHEMA_VERSION):
        base = base.rstrip("/")
        self.spark = spark
        self.records = Batches(spark, f"{base}/version_{version}", RAW_SCHEMA)
        self.points = ResumePoints(spark, f"{base}/offsets_{version}")

    @property
    def path(self) -> str:
        return self.records.path

    def read(self) -> DataFrame:
        return self.records.read()

    def distinct(self) -> DataFrame:
        """Each record once, should a source have delivered it twice."""
        return self.read().dropDuplicates(["partition", "offset"])

    def read_since(self, points: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The records at or after resume points, and the points that reading them leads to.

        Landings that lie wholly before the points are not opened, and of the others only row
        groups that may hold a wanted record.
        """
        start = pinned(points)
        numbers = self.records.numbers()
        last = max(numbers, default=0)
        done = self.points.last_within(start)
        reached = self.points.get(numbers, lambda n: self.records.read(after=n, upto=last))
        return from_points(self.records.read(after=done, upto=last), start), reached

    def _points(self, before: int | None = None) -> DataFrame:
        return self.points.get(self.records.numbers(), lambda n: self.records.read(after=n), before)

    def next_offsets(self) -> DataFrame:
        """Where the next landing starts, per topic partition."""
        return self._points()

    def append(self, decoded: DataFrame, number: int | None = None, start: DataFrame | None = None) -> int:
        """Add records; ``start`` are the resume points before them, if the caller has them."""
        number = self.records.write(decoded, number)
        return self._reached(number, start)

    def append_some(self, decoded: DataFrame, start: DataFrame | None = None) -> int | None:
        """The same as the next landing, unless there is nothing new."""
        number = self.records.write_some(decoded)
        return None if number is None else self._reached(number, start)

    def _reached(self, number: int, start: DataFrame | None) -> int:
        if start is None:
            points = self._points(before=number)
        else:
            points = advance(start, self.records.read_one(number))
        self.points.save(points, number)
        return number
