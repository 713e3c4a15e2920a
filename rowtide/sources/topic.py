"""Topics: Kafka, and a stand-in with Kafka's record columns kept as Parquet files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.session import pinned, scratch
from rowtide.sources.batches import Batches
from rowtide.sources.points import ResumePoints
from rowtide.spec import TOPIC_SCHEMA

RECORD = ("key", "value", "topic", "partition", "offset", "timestamp")


# Makes messages of rows and keeps the columns it is given the names of.
Render = Callable[..., DataFrame]


def as_they_are(messages: DataFrame, *keep: str) -> DataFrame:
    """For messages that are rendered already."""
    return messages


class Topic:
    """A stand-in topic: numbered segments with Kafka's columns."""

    def __init__(self, spark: SparkSession, path: str, name: str, partitions: int = 4):
        self.spark, self.name, self.partitions = spark, name, partitions
        self.segments = Batches(spark, path, TOPIC_SCHEMA, "segment")
        self.points = ResumePoints(spark, path)

    @property
    def path(self) -> str:
        return self.segments.path

    def read(self) -> DataFrame:
        return self.segments.read()

    def ends(self) -> DataFrame:
        """Next offset per partition."""
        return self.points.get(self.segments.numbers(), lambda n: self.segments.read(after=n))

    def append(self, records: DataFrame) -> int:
        """Add records that already have their partition and offset."""
        number = self.segments.write(records.select(*RECORD))
        self.points.save(self.ends(), number)
        return number

    def publish(
        self, rows: DataFrame, order: list[str], render: Render = as_they_are, ordered: bool = True
    ) -> DataFrame:
        """Add messages in the given total order.

        ``rows`` have a ``key`` and the order columns; ``render`` makes of them, keeping the
        columns it is told to, the ``key``, ``value`` and ``timestamp`` of the messages. Equal
        keys go to one partition unless a ``partition`` column says otherwise. Offsets rise with
        ``order`` within a partition and have gaps, as a topic's may: one range sort places the
        rows, and a row's offset is its number in it after the partition's end. Without
        ``ordered`` (a key occurs once) nothing is shuffled.

        The messages are written once, as the segment, with every rendered column; returns them
        read back from there, so marking rows as sent can never mark one that was not.
        """
        if "partition" not in rows.columns:
            spread = F.pmod(F.hash("key"), F.lit(self.partitions)).cast("int")
            rows = rows.withColumn("partition", spread)
        if ordered:
            rows = rows.repartitionByRange("partition", *order).sortWithinPartitions("partition", *order)
        placed = render(rows, "partition").withColumn("_n", F.monotonically_increasing_id())
        ends = pinned(self.ends())  # one row per topic partition
        sent = placed.join(F.broadcast(ends), "partition", "left").withColumn(
            "offset", F.coalesce("next_offset", F.lit(0)) + F.col("_n")
        )
        sent = sent.drop("_n", "next_offset").withColumn("topic", F.lit(self.name))
        sent = sent.withColumns({c: F.col(c).cast("binary") for c in ("key", "value")})
        number = self.segments.write_some(sent)
        if number is None:
            return self.spark.createDataFrame([], sent.schema)
        self.points.save(self.ends(), number)
        return self.spark.read.schema(sent.schema).parquet(self.segments.directory(number))


def kafka_read_options(servers: str, topic: str, starting_offsets: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }


def read_kafka(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest") -> DataFrame:
    """Bounded read of a Kafka topic up to its present end; needs Spark's Kafka connector."""
    options = kafka_read_options(servers, topic, starting_offsets)
    return spark.read.format("kafka").options(**options).load()


class KafkaTopic:
    """A Kafka topic that jobs publish to; needs Spark's Kafka connector."""

    def __init__(self, spark: SparkSession, servers: str, name: str):
        self.spark, self.servers, self.name = spark, servers, name

    def messages(self, rows: DataFrame, render: Render = as_they_are) -> DataFrame:
        """Messages as a written table, from which they are sent and marked."""
        path = scratch(self.spark, "messages")
        messages = render(rows)
        messages.write.parquet(path)
        return self.spark.read.schema(messages.schema).parquet(path)

    def publish(
        self, rows: DataFrame, order: list[str], render: Render = as_they_are, ordered: bool = True
    ) -> DataFrame:
        """Send messages; returns them read back, as ``Topic.publish`` does. Without ``ordered`` (a key
        occurs once) nothing is shuffled."""
        staged = self.messages(rows, render)
        write_kafka(staged, self.servers, self.name, order if ordered else None)
        return staged


def write_kafka(messages: DataFrame, servers: str, topic: str, order: list[str] | None = None) -> None:
    """Send ``key`` and ``value`` messages to Kafka; needs Spark's Kafka connector.

    With ``order`` the rows of a key are sent by one task, in order, as Kafka keeps them in one
    partition; drain a long log in rounds with a limit, which bounds what a task sends. Leave it
    out where a key occurs only once, as in a snapshot or a poll: then nothing is shuffled.
    """
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    sendable(messages, order).write.format("kafka").options(**options).save()


def sendable(messages: DataFrame, order: list[str] | None) -> DataFrame:
    """What the Kafka writer is handed."""
    if order:
        messages = messages.repartition("key").sortWithinPartitions("key", *order)
    return messages.select("key", "value")
