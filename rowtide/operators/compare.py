"""Comparing two versions of a table by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.messages import json_object
from rowtide.functions.times import to_iso
from rowtide.operators.merge import CHANGE, STATE, pair, quoted
from rowtide.session import pinned

#: Bits of a key's hash that name its range: in the upper level of the digest tree, and in its leaves.
TOP_BITS, LEAF_BITS = 8, 16

DIGEST_SCHEMA = "range long, n long, digest long"


def _distinct(column: str) -> Column:
    return ~F.col(quoted(STATE + column)).eqNullSafe(F.col(quoted(CHANGE + column)))


def _image(df: DataFrame, prefix: str, key: str) -> Column:
    """Row image as JSON text, NULL where the row is absent. Times are ISO text, as JSON
    writing would cut them to milliseconds."""
    values = {
        name: to_iso(F.col(quoted(prefix + name))) if kind.startswith("timestamp") else F.col(quoted(prefix + name))
        for name, kind in df.dtypes
    }
    return F.when(F.col(quoted(prefix + key)).isNotNull(), json_object(values))


def diff_snapshots(
    before: DataFrame, after: DataFrame, key: str, table: str, changed_at: Column | None = None
) -> DataFrame:
    """Change-log rows that lead from one snapshot of a table to another.

    Rows only in ``after`` are inserts with the new image, rows only in ``before`` deletes with
    the old one, rows that differ in any column updates with both. Keys are unique per side.
    Rows have no ``change_id``; number them, with gaps, where one is needed.
    """
    columns = [c for c in after.columns if c != key]
    pairs = pair(before.select(*after.columns), after, key)
    changed = F.lit(False)
    for c in columns:
        changed = changed | _distinct(c)
    operation = (
        F.when(F.col(quoted(STATE + key)).isNull(), "I").when(F.col(quoted(CHANGE + key)).isNull(), "D").when(changed, "U")
    )
    return (
        pairs.withColumn("operation", operation)
        .filter(F.col("operation").isNotNull())
        .select(
            F.lit(table).alias("table_name"),
            "operation",
            F.coalesce(STATE + key, CHANGE + key).alias("record_id"),
            _image(before.select(*after.columns), STATE, key).alias("old_data"),
            _image(after, CHANGE, key).alias("new_data"),
            (F.current_timestamp() if changed_at is None else changed_at).alias("changed_at"),
            F.lit(False).alias("processed"),
        )
    )


def reconcile(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows on which a target disagrees with its source: ``missing`` from the target, ``extra``
    in it, or ``different`` with the names of the columns that differ."""
    columns = [c for c in source.columns if c != key]
    pairs = pair(source, target.select(*source.columns), key)
    names = F.concat_ws(",", *[F.when(_distinct(c), c) for c in columns])
    status = (
        F.when(F.col(quoted(CHANGE + key)).isNull(), "missing")
        .when(F.col(quoted(STATE + key)).isNull(), "extra")
        .when(names != "", "different")
    )
    return (
        pairs.select(
            F.coalesce(STATE + key, CHANGE + key).alias(key),
            status.alias("status"),
            F.when(status == "different", names).alias("columns"),
        )
        .filter(F.col("status").isNotNull())
    )


def reconcile_counts(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    return reconcile(source, target, key).groupBy("status").agg(F.count("*").alias("n"))


def _range(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(quoted(key))), 64 - bits)


def digests(table: DataFrame, key: str) -> DataFrame:
    """For each range of key hashes: ``n`` rows and a ``digest`` of them, at most ``2 ** LEAF_BITS`` rows in all.

    The leaves of a digest tree. They are summed up before they are shuffled, so a pass over a table of any size
    sends at most one small row per range and task.
    """
    columns = [F.col(quoted(c)) for c in table.columns]
    # A hash leaves NULLs out, so which columns are NULL is hashed too.
    absent = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    rows = table.select(_range(key, LEAF_BITS).alias("range"), F.xxhash64(*columns, absent).alias("row"))
    return rows.groupBy("range").agg(F.count("*").alias("n"), F.bit_xor("row").alias("digest"))


def _differ(one: DataFrame, other: DataFrame) -> DataFrame:
    """Ranges whose digests are not the same on both sides."""
    same = F.struct(F.col("n"), F.col("digest"))
    sides = one.select("range", same.alias("a")).join(other.select("range", same.alias("b")), "range", "full_outer")
    return sides.filter("NOT (a <=> b)").select("range")


def differing_ranges(one: DataFrame, other: DataFrame) -> DataFrame:
    """Leaf ranges whose digests differ; leaves are compared only below upper ranges that differ."""

    def upper(leaves: DataFrame) -> DataFrame:
        above = F.shiftright("range", LEAF_BITS - TOP_BITS).alias("range")
        return leaves.groupBy(above).agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"))

    tops = F.broadcast(_differ(upper(one), upper(other)).withColumnRenamed("range", "top"))
    below = [x.join(tops, F.shiftright("range", LEAF_BITS - TOP_BITS) == F.col("top"), "left_semi") for x in (one, other)]
    return _differ(*below)


def reconcile_digest(source: DataFrame, target: DataFrame, key: str, target_digests: DataFrame | None = None) -> DataFrame:
    """What ``reconcile`` finds, joining only rows of key ranges in which the two sides differ.

    One pass over each side makes its digests; the target's may be given, as a state store keeps them. Where the
    sides agree nothing is shuffled but digests. Ranges come from the hash of the key, so they are even; the differing
    ones, at most ``2 ** LEAF_BITS`` numbers, are broadcast.
    """
    source = source.select(*[F.col(quoted(c)).cast(target.schema[c].dataType).alias(c) for c in source.columns])
    target = target.select(*source.columns)
    theirs = digests(target, key) if target_digests is None else target_digests
    found = pinned(differing_ranges(digests(source, key), theirs))
    if found.isEmpty():
        return reconcile(source.limit(0), target.limit(0), key)
    marked = F.broadcast(found)
    near = [x.withColumn("_range", _range(key, LEAF_BITS)).join(marked, F.col("_range") == F.col("range"), "left_semi") for x in (source, target)]
    return reconcile(*[x.drop("_range") for x in near], key)
