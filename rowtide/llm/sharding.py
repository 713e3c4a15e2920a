"""Shards of near equal bytes from indivisible groups, by Karmarkar-Karp differencing.

Rows with equal texts are one group. A task holds a bounded bucket of groups, each a partial partition: its
size on one shard and nothing on the others. The two partial partitions with the largest spread are combined
in opposite order (the largest sum of one with the smallest of the other), and so on until one is left.
The partitions that are left of up to ``FAN`` buckets are combined in the same way in the next level, until a
single one is: a tree of tasks of bounded size. What a level decides is a small table that maps the slots of
a bucket to the slots of its parent.

Buckets that are even by themselves cannot make room for a group that is large beside a bucket. Groups of more than a
shard's share of a bucket are therefore put on shards first, by the same steps, and every bucket of the others
starts from its part of their sums: one more partial partition, whose columns say which shard a slot is.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.frames import col, kept

SHARDS = 24
#: Groups of a bucket, and buckets that a task of the next level combines.
BUCKET, FAN = 16_384, 512
#: Rows of a shard are numbered in stretches of about so many.
STRETCH = 100_000


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows of sums, one column per slot). Returns the final slot of each row's
    columns, and the final sums, largest first."""
    n, k = parts.shape
    order = np.argsort(-parts, axis=1, kind="stable")
    sums = [row for row in np.take_along_axis(parts, order, 1)]
    heap = [(-(row[0] - row[-1]), i) for i, row in enumerate(sums)]
    heapq.heapify(heap)
    made: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums[a] + sums[b][::-1]
        by = np.argsort(-both, kind="stable")
        sums[a], sums[b] = None, None
        sums.append(both[by])
        made.append((a, b, by))
        heapq.heappush(heap, (-(sums[-1][0] - sums[-1][-1]), len(sums) - 1))
    slots: list = [None] * len(sums)
    slots[-1] = np.arange(k)
    for number in range(len(made) - 1, -1, -1):
        a, b, by = made[number]
        mine, slots[n + number] = slots[n + number], None
        loose = np.empty(k, np.int64)
        loose[by] = mine
        slots[a], slots[b] = loose, loose[::-1]
    final = np.empty((n, k), np.int64)
    np.put_along_axis(final, order, np.stack(slots[:n]), 1)
    return final, sums[-1]


def _bucketed(groups: DataFrame, buckets: int, shards: int, seeds: np.ndarray | None = None) -> DataFrame:
    """First level: ``key, bucket, slot`` and its ``bytes``, packed by one task per bucket. With ``seeds``, what
    the shards hold already, every bucket evens out its part of them, and slots are shards."""
    rows = groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))

    def level(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bytes", "descending"), ("key", "ascending")])
        parts = np.zeros((len(table), shards), np.int64)
        parts[:, 0] = table.column("bytes").to_numpy()
        if seeds is not None:
            parts = np.vstack([parts, seeds // buckets])
        final, _ = difference(parts)
        slot = final[: len(table), 0]
        return table.append_column("slot", pa.array(slot if seeds is None else np.argsort(final[-1])[slot]))

    return rows.groupBy("bucket").applyInArrow(level, "key binary, bytes long, bucket long, slot long")


def _combined(sums: DataFrame, shards: int) -> DataFrame:
    """One level: partial partitions (``part, slot, bytes``) to ``part, slot, parent, parent_slot, bytes``."""
    rows = sums.withColumn("parent", F.floor(F.col("part") / FAN).cast("long"))

    def level(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("slot", "ascending")])
        part, slot = table.column("part").to_numpy(), table.column("slot").to_numpy()
        names, which = np.unique(part, return_inverse=True)
        parts = np.zeros((len(names), shards), np.int64)
        parts[which, slot] = table.column("bytes").to_numpy()
        final, _ = difference(parts)
        return table.append_column("parent_slot", pa.array(final[which, slot]))

    return rows.groupBy("parent").applyInArrow(level, "part long, slot long, bytes long, parent long, parent_slot long")


def shares(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``key`` and ``shard`` (0 to ``shards`` - 1) of groups with columns ``key`` (binary) and ``bytes``."""
    count, total = groups.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    buckets = max(1, -(-count // BUCKET))
    if buckets > 1:
        # At least four times the mean, so that these are ever fewer.
        bound = max(total // (shards * buckets), 4 * total // count)
        large, _ = kept(groups.filter(F.col("bytes") > bound), "large")
        if not large.isEmpty():
            first, _ = kept(shares(large, shards).join(large, "key"), "first")
            seeds = np.zeros(shards, np.int64)
            for row in first.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():  # a row for each shard
                seeds[row["shard"]] = row["bytes"]
            rest = _bucketed(groups.filter(F.col("bytes") <= bound), buckets, shards, seeds)
            return first.select("key", "shard").unionByName(rest.select("key", F.col("slot").cast("int").alias("shard")))
    placed, _ = kept(_bucketed(groups, buckets, shards), "placed")
    sums = placed.groupBy(F.col("bucket").alias("part"), "slot").agg(F.sum("bytes").alias("bytes"))
    where = None
    while True:
        level, _ = kept(_combined(sums, shards), "level")
        step = level.select("part", "slot", "parent", "parent_slot")
        if where is None:
            where = step.withColumnRenamed("part", "bucket")
        else:
            up = step.select(
                F.col("part").alias("parent"),
                F.col("slot").alias("parent_slot"),
                F.col("parent").alias("up"),
                F.col("parent_slot").alias("up_slot"),
            )
            where = where.join(up, ["parent", "parent_slot"])
            where = where.select("bucket", "slot", F.col("up").alias("parent"), F.col("up_slot").alias("parent_slot"))
        if buckets <= FAN:
            break
        buckets = -(-buckets // FAN)
        sums = level.groupBy(F.col("parent").alias("part"), F.col("parent_slot").alias("slot")).agg(F.sum("bytes").alias("bytes"))
    return placed.join(where, ["bucket", "slot"]).select("key", F.col("parent_slot").cast("int").alias("shard"))


def sharded(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A row per document (repeated rows too): ``doc_id, size`` (UTF-8 bytes of the text and 8), ``text_crc32``,
    ``law`` (``bytes``), ``shard``, ``slot`` (gapless from 0 in each shard), ``grown_shard`` (null).

    Null texts are a group of their own with no bytes and the checksum of nothing.
    """
    text = col("text")
    rows, _ = kept(
        documents.select(
            col("doc_id").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b"null")).alias("key"),
        ),
        "rows",
    )
    groups, _ = kept(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    found = rows.join(shares(groups, shards), "key").drop("key")
    # Slots: a shard's rows in stretches by a hash, numbered each, after the stretches before.
    stretches = max(1, -(-rows.count() // (shards * STRETCH)))
    stretch = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(stretches))
    found, _ = kept(found.withColumn("stretch", stretch), "sharded")
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("stretch")) - F.col("n")
    counts = found.groupBy("shard", "stretch").agg(F.count("*").alias("n")).withColumn("before", before).drop("n")
    place = F.row_number().over(Window.partitionBy("shard", "stretch").orderBy("doc_id", "text_crc32")) - 1
    numbered = found.withColumn("place", place).join(counts, ["shard", "stretch"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
