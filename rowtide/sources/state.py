"""The keyed state table, as full versions and the changes since."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rowtide.operators.compare import DIGEST_SCHEMA, digests
from rowtide.operators.latest import latest_per_key
from rowtide.operators.merge import absorb, stored_rows
from rowtide.session import pinned
from rowtide.sources.batches import Batches, BucketedBatches, evened
from rowtide.sources.points import ResumePoints
from rowtide.spec import DELETED, ORDER, ORDER_TYPE, STORED_PLACE, TableSpec

Beside = Callable[[int], None] | None


class StateStore:
    """One row per key, with hidden columns for the order of the change that made it and for
    deletion, so that repeated or late changes have no effect.

    ``full=N`` directories hold the whole table, ``delta=N`` directories the latest change of
    the keys touched by one run. A run that touches few keys writes only those; readers merge
    them over the last full version, and ``compact`` folds them in. With ``buckets`` full
    versions are bucketed by key, so merging into one shuffles the changes but not the table. With ``even`` versions
    that are not bucketed have files of about the advised partition size.

    Specs may gain columns, and integers may get wider: versions keep the columns they were written with, a spec with
    a new column reads NULL from older versions, and a spec without a column keeps it for rows it does not
    change, also when it compacts. A change replaces its row whole: columns that its spec lacks become NULL.
    """

    def __init__(
        self, spark: SparkSession, path: str, spec: TableSpec, buckets: int | None = None, even: bool = False
    ):
        self.spark, self.spec, self.buckets, self.even = spark, spec, buckets, even
        if buckets:
            self.fulls = BucketedBatches(spark, path, spec.stored_schema, "full", spec.key, buckets)
        else:
            self.fulls = Batches(spark, path, spec.stored_schema, "full")
        self.deltas = Batches(spark, path, spec.stored_schema, "delta")
        self.points = ResumePoints(spark, path)
        self.digested = Batches(spark, path, DIGEST_SCHEMA, "digest")

    def _next(self) -> int:
        return max(self.fulls.last(), self.deltas.last()) + 1

    def _base(self) -> int:
        return max(self.fulls.numbers(), default=0)

    def exists(self) -> bool:
        return bool(self.fulls.numbers() or self.deltas.numbers())

    def versions(self) -> list[int]:
        return sorted({*self.fulls.numbers(), *self.deltas.numbers()})

    def pending_deltas(self) -> list[int]:
        base = self._base()
        return [n for n in self.deltas.numbers() if n > base]

    def schema(self) -> StructType:
        """Columns of the stored rows: those of the spec, then those that live versions have besides, with the newest
        version's type, as another spec has written them."""
        base = self._base()
        live = [(n, self.deltas) for n in self.pending_deltas()] + ([(base, self.fulls)] if base else [])
        known = self.spark.createDataFrame([], self.spec.stored_schema).schema
        more = {}
        for number, kind in sorted(live, key=lambda x: -x[0]):
            for field in kind.fields(number):
                if field.name not in known.names:
                    more.setdefault(field.name, StructField(field.name, field.dataType))
        return StructType([*known.fields, *more.values()])

    def rows(self) -> DataFrame:
        """Stored rows, deleted ones included. A row whose version was written without a column has NULL there."""
        base, schema = self._base(), self.schema()
        newer = self.deltas.read(after=base, schema=schema)
        if not base:
            return latest_per_key(newer, self.spec.key, STORED_PLACE)
        full = self.fulls.read_one(base, schema)
        if not self.pending_deltas():
            return full
        return absorb(full, latest_per_key(newer, self.spec.key, STORED_PLACE), self.spec)

    def current(self, more: bool = False) -> DataFrame:
        """The state table, in the columns of the spec; with ``more`` also in those that other specs have added."""
        rows = self.rows().filter(~F.col(DELETED))
        return rows.drop(DELETED, ORDER) if more else rows.select(*self.spec.columns)

    def digests(self) -> DataFrame:
        """Digests of the table's key ranges, made once for each version and kept beside it: comparing a table with
        one that has not changed since does not read it."""
        number = max(self.versions(), default=0)
        if number not in self.digested.numbers():
            self.digested.write(digests(self.current(), self.spec.key).coalesce(1), number)
        return self.digested.read_one(number)

    def _places(self, after: int) -> DataFrame:
        stored = self.fulls.read(after=after).unionByName(self.deltas.read(after=after))
        return stored.filter(F.col(ORDER).isNotNull()).select(f"{ORDER}.partition", f"{ORDER}.offset")

    def applied_offsets(self, before: int | None = None) -> DataFrame:
        """Next offset to apply per topic partition.

        Where a version does not say what was read for it, this is derived from the orders of
        its rows: a partition's last usable record is the latest change of its key, hence there.
        """
        return self.points.get(self.versions(), self._places, before)

    def _commit(self, kind: Batches, rows: DataFrame, points: DataFrame | None, beside: Beside = None) -> int:
        if self.even and not isinstance(kind, BucketedBatches):
            rows = evened(rows)
        number = kind.write(rows, self._next(), beside)
        self.points.save(self.applied_offsets(before=number) if points is None else points, number)
        return number

    def load(self, table: DataFrame) -> int:
        """Start from a plain table whose rows have no change history."""
        rows = table.select(
            *self.spec.columns, F.lit(False).alias(DELETED), F.lit(None).cast(ORDER_TYPE).alias(ORDER)
        )
        return self._commit(self.fulls, rows, None)

    def apply(self, latest: DataFrame, points: DataFrame | None = None, beside: Beside = None) -> int:
        """Record the latest ordered change of each touched key. ``points`` are the resume
        points after the records the changes come from, unusable ones included. ``beside`` is called with the
        version's number once the changes have been computed, before the version is in place."""
        return self._commit(self.deltas, stored_rows(latest, self.spec), points, beside)

    def rebuild(
        self, latest: DataFrame, points: DataFrame | None = None, afresh: bool = False, beside: Beside = None
    ) -> int:
        """Merge many changes at once and write the whole table; ``afresh`` from these alone."""
        incoming = stored_rows(latest, self.spec)
        if not afresh:
            added = [x for x in self.schema().fields if x.name not in incoming.columns]
            incoming = incoming.select("*", *[F.lit(None).cast(x.dataType).alias(x.name) for x in added])
        if self.buckets:
            # Match the table's buckets, or Spark may shuffle the table to match the changes.
            incoming = incoming.repartition(self.buckets, self.spec.key)
        rows = absorb(self.rows(), incoming, self.spec) if self.exists() and not afresh else incoming
        return self._commit(self.fulls, rows, points, beside)

    def compact(self) -> int:
        """Write the merged table as a new full version."""
        return self._commit(self.fulls, self.rows(), pinned(self.applied_offsets()))

    def purge(self, keep: int = 1) -> None:
        """Delete what the newest ``keep`` full versions do not need. Readers of older
        versions must be done."""
        fulls = self.fulls.numbers()
        if len(fulls) < keep:
            return
        oldest = fulls[-keep]
        self.points.drop([n for n in self.points.kept.numbers() if n < oldest])
        self.fulls.drop([n for n in fulls if n < oldest])
        self.deltas.drop([n for n in self.deltas.numbers() if n < oldest])
        self.digested.drop([n for n in self.digested.numbers() if n < oldest])
