"""Numbered directories of Parquet files, each visible only once it is complete."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rowtide.session import delete_path, move, qualified


def evened(rows: DataFrame) -> DataFrame:
    """Rows to be written in files of about the advised size: adaptive execution splits what is large and
    joins what is small, by the sizes of a shuffle (``spark.sql.adaptive.advisoryPartitionSizeInBytes``). It cuts
    between the outputs of the tasks that read, so a file is never less than what one of these sends to it."""
    return rows.hint("rebalance")


class Batches:
    """Tables written as ``<path>/<prefix>=<number>``, one directory per write.

    A batch is written under ``_writing`` and moved to its place whole, so neither a reader nor a
    stream over the directories ever sees a write that failed half way. Paths go
    through Hadoop's file system API and may lie on any store Spark can reach. There may be
    many readers but only one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, prefix: str = "batch"):
        self.spark, self.path, self.schema, self.prefix = spark, qualified(spark, path), schema, prefix
        self._fields: dict[int, list[StructField]] = {}

    def _glob(self, pattern: str) -> list[str]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        where = hadoop.Path(f"{self.path}/{pattern}")
        found = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(where)
        return [str(status.getPath().toString()) for status in found or []]

    def _numbers(self, pattern: str, part: int) -> list[int]:
        return sorted(int(p.rstrip("/").split("/")[part].split("=")[1]) for p in self._glob(pattern))

    def numbers(self) -> list[int]:
        """Complete batches, oldest first. A read error is raised, not taken for emptiness."""
        return self._numbers(f"{self.prefix}=*/_SUCCESS", -2)

    def last(self) -> int:
        """The highest number in use, complete or not; 0 if there is none."""
        return max(self._numbers(f"{self.prefix}=*", -1), default=0)

    def directory(self, number: int) -> str:
        return f"{self.path}/{self.prefix}={number:08d}"

    def chosen(self, after: int = 0, upto: int | None = None) -> list[int]:
        return [n for n in self.numbers() if n > after and (upto is None or n <= upto)]

    def read(self, after: int = 0, upto: int | None = None, schema: StructType | None = None) -> DataFrame:
        """The rows of all complete batches, or of those in a range of numbers, in the store's schema or another one:
        columns that a batch was written without are NULL, and integers of a narrower type are widened."""
        numbers = self.chosen(after, upto)
        if not numbers:
            # The limit lets the optimizer see that there is nothing, and drop what depends on it.
            return self.spark.createDataFrame([], schema or self.schema).limit(0)
        return self.spark.read.schema(schema or self.schema).parquet(*[self.directory(n) for n in numbers])

    def read_one(self, number: int, schema: StructType | None = None) -> DataFrame:
        return self.read(after=number - 1, upto=number, schema=schema)

    def fields(self, number: int) -> list[StructField]:
        """The columns a batch was written with, from one of its files; batches do not change, so they are asked once."""
        if number not in self._fields:
            self._fields[number] = self.spark.read.parquet(self.directory(number)).schema.fields
        return self._fields[number]

    def read_numbered(self) -> DataFrame:
        """The rows of all complete batches with a ``number`` column."""
        if not self.numbers():
            return self.read().withColumn("number", F.lit(0))
        numbered = self.spark.read.schema(f"{self.schema}, {self.prefix} int").option("basePath", self.path)
        return numbered.parquet(*[self.directory(n) for n in self.numbers()]).withColumnRenamed(
            self.prefix, "number"
        )

    def write(self, df: DataFrame, number: int | None = None, beside: Callable[[int], None] | None = None) -> int:
        """Write the next batch. Giving the number again replaces that batch, which makes the
        retry of a streaming micro-batch harmless. ``beside`` is called with the number when the rows are
        written, before a reader can see them."""
        number = self.last() + 1 if number is None else number
        staged = self._stage(df, number)
        if beside:
            beside(number)
        move(self.spark, staged, self.directory(number))
        self._fields[number] = df.schema.fields
        return number

    def write_some(self, df: DataFrame) -> int | None:
        """Write the next batch unless there are no rows. The rows are computed once: whether there
        are any is asked of the written files, before a reader can see them."""
        number = self.last() + 1
        staged = self._stage(df, number)
        if self.spark.read.schema(df.schema).parquet(staged).isEmpty():
            delete_path(self.spark, staged)
            return None
        move(self.spark, staged, self.directory(number))
        return number

    def _stage(self, df: DataFrame, number: int) -> str:
        staged = f"{self.path}/_writing/{self.prefix}={number:08d}"
        df.write.mode("overwrite").parquet(staged)
        return staged

    def drop(self, numbers: list[int]) -> None:
        for n in numbers:
            delete_path(self.spark, self.directory(n))


class BucketedBatches(Batches):
    """Batches whose files are bucketed by a key, so that joining one on the key does not
    shuffle it. Spark knows buckets only of catalog tables: each batch is an external table
    over its directory, entered in the session's catalog when it is read."""

    def __init__(self, spark: SparkSession, path: str, schema: str, prefix: str, key: str, buckets: int):
        super().__init__(spark, path, schema, prefix)
        self.key, self.buckets = key, buckets

    def _table(self, number: int, columns: str = "") -> str:
        return "rowtide_" + hashlib.md5((self.directory(number) + columns).encode()).hexdigest()

    def read(self, after: int = 0, upto: int | None = None, schema: StructType | None = None) -> DataFrame:
        numbers = self.chosen(after, upto)
        if len(numbers) != 1:
            return super().read(after, upto, schema)
        columns = self.schema if schema is None else schema.toDDL()
        # A table of its own for each set of columns that the batch is read with.
        table = self._table(numbers[0], columns)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.directory(numbers[0]).replace("'", "\\'")}'"
        )
        return self.spark.table(table)

    def write(self, df: DataFrame, number: int | None = None, beside: Callable[[int], None] | None = None) -> int:
        """A bucketed batch is a table, which cannot be moved: ``beside`` is called after readers see it."""
        mode = "error" if number is None else "overwrite"
        number = self.last() + 1 if number is None else number
        # A task holds whole buckets, so there is one file for each.
        dealt = df.repartition(self.buckets, self.key)
        writer = dealt.write.mode(mode).format("parquet").bucketBy(self.buckets, self.key)
        writer.option("path", self.directory(number)).saveAsTable(self._table(number))
        self._fields[number] = df.schema.fields
        if beside:
            beside(number)
        return number

    def drop(self, numbers: list[int]) -> None:
        for n in numbers:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(n)}")
        super().drop(numbers)
