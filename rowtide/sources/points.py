"""Resume points kept beside the numbered directories they were derived from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.offsets import advance
from rowtide.sources.batches import Batches
from rowtide.spec import OFFSETS_SCHEMA


class ResumePoints:
    """Next offset per topic partition as of each version of a store.

    The stored data stays the authority: points are written after the version they describe,
    and versions without points yet are scanned for theirs. So data and points cannot
    disagree, and finding where to go on does not read the history again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.kept = Batches(spark, path, OFFSETS_SCHEMA, "points")

    def get(
        self, versions: list[int], places: Callable[[int], DataFrame], before: int | None = None
    ) -> DataFrame:
        """Points as of the last of ``versions``. ``places`` gives the partition and offset of the
        records stored after a version; points of version ``before`` and later are not trusted."""
        usable = [n for n in self.kept.numbers() if n in set(versions) and (before is None or n < before)]
        last = max(usable, default=0)
        points = self.kept.read_one(last)
        return points if max(versions, default=0) <= last else advance(points, places(last))

    def save(self, points: DataFrame, version: int) -> None:
        self.kept.write(points.coalesce(1), version)

    def last_within(self, points: DataFrame) -> int:
        """The last version that lies wholly before ``points``, as far as its own are kept."""
        reached = points.withColumnRenamed("next_offset", "_reached")
        ahead = self.kept.read_numbered().join(F.broadcast(reached), "partition", "left")
        beyond = F.col("next_offset") > F.coalesce("_reached", F.lit(0))
        first_beyond = ahead.filter(beyond).agg(F.min("number")).first()[0]
        return max((n for n in self.kept.numbers() if first_beyond is None or n < first_beyond), default=0)

    def drop(self, versions: list[int]) -> None:
        self.kept.drop(versions)
