"""The jobs as Structured Streaming queries.

Each returns the running query. The default trigger processes what is there and stops, like
the batch jobs; ``trigger={"processingTime": "2 seconds"}`` keeps polling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.audit import capture_lag
from rowtide.operators.parse import decode, parse
from rowtide.plans.jobs import newest_and_rejected, newest_changes, publish_changes
from rowtide.session import path_exists
from rowtide.sources.raw import RawStore
from rowtide.sources.rejects import Rejects
from rowtide.sources.state import StateStore
from rowtide.sources.topic import Topic, kafka_read_options
from rowtide.spec import RAW_SCHEMA, TOPIC_SCHEMA, TableSpec

CAUGHT_UP = {"availableNow": True}
IDLE_POLL = {"processingTime": "2 seconds"}


def read_topic_stream(topic: Topic, files_per_batch: int | None = None) -> DataFrame:
    """A stand-in topic as a stream of Kafka-shaped records."""
    reader = topic.spark.readStream.schema(TOPIC_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{topic.path}/segment=*")


def read_raw_stream(raw: RawStore) -> DataFrame:
    """A raw store as a stream of landed records."""
    return raw.spark.readStream.schema(RAW_SCHEMA).parquet(f"{raw.path}/batch=*")


def read_kafka_stream(spark, servers: str, topic: str) -> DataFrame:
    """A Kafka topic as a stream; needs Spark's Kafka connector."""
    return spark.readStream.format("kafka").options(**kafka_read_options(servers, topic)).load()


def _start(stream: DataFrame, each, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or CAUGHT_UP)).start()


def each_once(records: DataFrame, within: str) -> DataFrame:
    """A stream without records that come again, by partition and offset, up to ``within`` after they first came.

    The clock is the time of arrival, not the record's own, so a record can be as old as it likes: none is
    dropped for being late. What is remembered is bounded by the records that arrive ``within`` that time.
    """
    arrived = records.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(["partition", "offset"]).drop("_arrived")


def stream_land(
    records: DataFrame,
    raw: RawStore,
    checkpoint: str,
    trigger: dict | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Topic records to the raw store. A retried micro-batch replaces its own directory, so
    records land exactly once. The store must have no other landing job, and a store that has
    records is only continued with the checkpoint it was filled with, as a new one would
    number its micro-batches from the start and replace them.

    A source that delivers records twice needs ``repeats_within``, how much later the second may come (``each_once``);
    records are then shuffled by their place."""
    if repeats_within:
        records = each_once(records, repeats_within)
    if raw.records.numbers() and not path_exists(raw.spark, checkpoint):
        raise ValueError(f"{raw.path} has records but {checkpoint} is a new checkpoint")

    def each(batch: DataFrame, number: int) -> None:
        raw.append(decode(batch), number + 1)

    return _start(records, each, checkpoint, trigger)


def stream_apply(
    records: DataFrame,
    state: StateStore,
    spec: TableSpec,
    checkpoint: str,
    trigger: dict | None = None,
    rejects: Rejects | None = None,
    **options: str,
) -> StreamingQuery:
    """Topic or landed records to the state table. A micro-batch writes only the keys it touches;
    ``compact`` them into a full version by a job of its own. Retries change nothing. ``rejects`` keeps what cannot
    be applied and the counts, by the number of the micro-batch; it is of this stream alone."""

    def each(batch: DataFrame, number: int) -> None:
        landed = decode(batch) if "value" in batch.columns else batch
        if rejects is None:
            state.apply(newest_changes(landed, spec, **options))
            return
        newest, rejected, tally = newest_and_rejected(landed, spec, **options)
        state.apply(newest, beside=lambda _: rejects.save(rejected, tally.counts(), number + 1))

    return _start(records, each, checkpoint, trigger)


def stream_lag(
    records: DataFrame, spec: TableSpec, path: str, checkpoint: str, every: str, delay: str, trigger: dict | None = None
) -> StreamingQuery:
    """The capture lag of each window of ``every``, as Parquet at ``path`` once no record of the window is waited for:
    when records ``delay`` later have come."""
    found = capture_lag(parse(decode(records), spec), every, delay)
    writer = found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or CAUGHT_UP)).start()


def stream_drain(
    changelog: DataFrame, topic: Topic, spec: TableSpec, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Change-log rows to a topic. The stream's checkpoint remembers what was sent; a retried
    micro-batch may send again, never skip."""

    def each(batch: DataFrame, number: int) -> None:
        publish_changes(batch, topic, spec)

    return _start(changelog, each, checkpoint, trigger or IDLE_POLL)
