"""Resume points of a topic reader, derived from what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.session import pinned

EARLIEST = -2  # Kafka's marker for the start of a partition


def resume_offsets(landed: DataFrame) -> DataFrame:
    """Next offset per partition: the highest landed one plus one."""
    return landed.groupBy("partition").agg((F.max("offset") + 1).alias("next_offset"))


def advance(points: DataFrame, landed: DataFrame) -> DataFrame:
    """Resume points moved past newly landed records."""
    reached = landed.select("partition", (F.col("offset") + 1).alias("next_offset"))
    return points.unionByName(reached).groupBy("partition").agg(F.max("next_offset").alias("next_offset"))


def all_partitions(offsets: DataFrame, partitions: int) -> DataFrame:
    """Add the topic partitions nothing has landed from, which start at the earliest record."""
    every = offsets.sparkSession.range(partitions).select(F.col("id").cast("int").alias("partition"))
    return every.join(offsets, "partition", "left").select(
        "partition", F.coalesce("next_offset", F.lit(EARLIEST)).alias("next_offset")
    )


def starting_offsets_json(offsets: DataFrame, topic: str) -> DataFrame:
    """One row, ``starting_offsets``: ``{"topic":{"0":n,...}}``, or ``earliest`` without offsets."""
    entries = F.sort_array(F.collect_list(F.struct("partition", "next_offset")))
    by_partition = F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["partition"].cast("string"), e["next_offset"]))
    )
    rendered = F.to_json(F.create_map(F.lit(topic), by_partition))
    return offsets.agg(F.when(F.count("*") > 0, rendered).otherwise("earliest").alias("starting_offsets"))


def since(records: DataFrame, offsets: DataFrame) -> DataFrame:
    """Records at or after the resume points; a partition without one is read from its start.

    Resume points come to the driver, one row per topic partition, as Kafka's own start option
    needs them; for the same reason they can be broadcast whatever the size of the data.
    """
    return from_points(records, pinned(offsets))


def from_points(records: DataFrame, start: DataFrame) -> DataFrame:
    """``since`` with resume points that are already pinned."""
    points = start.collect()
    if not points:
        return records
    # Implied by the join condition below, but in a form the Parquet reader can use to skip
    # files and row groups that lie wholly before every resume point.
    floor = min(p["next_offset"] for p in points)
    maybe_new = (F.col("offset") >= floor) | ~F.col("partition").isin(*[p["partition"] for p in points])
    return (
        records.filter(maybe_new)
        .join(F.broadcast(start), "partition", "left")
        .filter(F.col("next_offset").isNull() | (F.col("offset") >= F.col("next_offset")))
        .select(*records.columns)
    )
