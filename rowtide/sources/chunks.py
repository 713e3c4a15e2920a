"""Ranges of keys that a table is read in, and how far a snapshot has come with them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rowtide.sources.batches import Batches

RANGES_SCHEMA = "chunk int, above long, upto long"


def key_ranges(keys: DataFrame, key: str, chunks: int) -> DataFrame:
    """Up to ``chunks`` ranges of keys that hold about as many rows each: keys above ``above``, up to ``upto``. The first
    and the last are open, so every key is in one range, also one that is given later. One pass over the keys."""
    shares = [n / chunks for n in range(1, chunks)]
    cuts = F.array_sort(F.array_distinct(F.percentile_approx(F.col(key), shares, max(10_000, 100 * chunks))))
    cuts = F.coalesce(cuts, F.array().cast("array<long>")) if shares else F.array().cast("array<long>")
    none = F.lit(None).cast("long")
    ends = keys.agg(cuts.cast("array<long>").alias("cuts")).select(
        F.concat(F.array(none), "cuts").alias("above"), F.concat("cuts", F.array(none)).alias("upto")
    )
    ranges = ends.select(F.posexplode(F.arrays_zip("above", "upto")).alias("chunk", "range"))
    return ranges.select("chunk", "range.above", "range.upto")


def in_range(table: DataFrame, key: str, chunk: Row) -> DataFrame:
    """The rows of a range; the bounds reach the scan. Rows without a key are in none."""
    rows = table.filter(F.col(key).isNotNull())
    if chunk.above is not None:
        rows = rows.filter(F.col(key) > chunk.above)
    return rows if chunk.upto is None else rows.filter(F.col(key) <= chunk.upto)


class ChunkProgress:
    """The ranges of one snapshot, fixed when it begins, and those that have been sent, with the time they count as of."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.ranges = Batches(spark, path, RANGES_SCHEMA, "ranges")
        self.sent = Batches(spark, path, "chunk int, as_of timestamp", "sent")

    def waiting(self, ranges: Callable[[], DataFrame]) -> list[Row]:
        """Ranges still to be sent, one row for each chunk; ``ranges`` makes them when there are none yet."""
        if not self.ranges.numbers():
            self.ranges.write(ranges())
        done = self.sent.numbers()
        chunks = self.ranges.read().orderBy("chunk").collect()
        return [x for x in chunks if x.chunk + 1 not in done]

    def finish(self, chunk: Row, as_of: datetime) -> None:
        self.sent.write(self.spark.createDataFrame([(chunk.chunk, as_of)], "chunk int, as_of timestamp"), chunk.chunk + 1)
