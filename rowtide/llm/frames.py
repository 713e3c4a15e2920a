"""Shared steps: rows in a struct, tables in the shared folder, groups of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.session import delete_path, pinned, scratch

#: Keys with more than one row in this many are joined by a broadcast.
HEAVY = 10_000


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def table(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows as a table in the shared folder, so that lost executors cost no earlier step; and its path."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return table(df, path), path


def drop(df: DataFrame, *paths: str) -> None:
    for path in paths:
        delete_path(df.sparkSession, path)


def whole_groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups, and their bounds (the end of the last included), from batches sorted by ``keys``."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if not len(rows):
            continue
        rows = pa.concat_tables([rest, rows]) if rest is not None and len(rest) else rows
        starts = group_starts(rows, *keys)
        last = starts[-1]
        if last:
            yield rows.slice(0, last).combine_chunks(), starts
        rest = rows.slice(last)
    if rest is not None and len(rest):
        yield rest.combine_chunks(), np.array([0, len(rest)])


def group_starts(rows: pa.Table, *keys: str) -> np.ndarray:
    """Places at which a key differs from the one before, the first row's included."""
    changed = np.zeros(len(rows), bool)
    changed[0] = True
    for key in keys:
        column = rows.column(key).combine_chunks()
        differ = pc.not_equal(column.slice(1), column.slice(0, len(rows) - 1))
        changed[1:] |= differ.to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)


def halves(df: DataFrame, sub: str, size: str, most: int) -> DataFrame:
    """Copies of rows, dealt by their group and ``low_block``, ``high_block``, so that tasks see all its pairs.

    A group whose ``size`` is at most ``most`` stays whole. A larger one is cut into n blocks by
    a hash of ``sub``, and each pair of blocks (low <= high) is a task of its own, to which n copies of each
    row go; so a group of any size is compared in full with bounded memory.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col(size) / most)).cast("int")
    mine = F.pmod(F.xxhash64(F.col(sub), F.lit("block")), F.col("blocks")).cast("int")
    return (
        df.withColumn("blocks", blocks)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low_block", F.least("mine", "other"))
        .withColumn("high_block", F.greatest("mine", "other"))
        .drop("blocks", "other")
    )


def looked_up(rows: DataFrame, facts: DataFrame, keys: list[str], counts: DataFrame, total: int) -> DataFrame:
    """``rows`` left joined with ``facts``, which has each key once, whatever a key's share of the rows.

    ``counts`` has the keys and ``n``, how many of the ``total`` rows have them. The facts of keys with more than one
    row in ``HEAVY`` (fewer than ``HEAVY`` keys) are broadcast; all other rows are joined by a shuffle.
    """
    heavy = pinned(facts.join(counts.filter(F.col("n") * HEAVY > total).select(*keys), keys, "left_semi"))
    often = rows.join(F.broadcast(heavy), keys)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(facts, keys, "left")
    return often.unionByName(rest)
