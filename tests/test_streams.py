"""Streams give what the batch jobs give."""

import pytest
from pyspark.sql import functions as F

from rowtide.plans import jobs
from rowtide.sources.raw import RawStore
from rowtide.sources.state import StateStore
from rowtide.sources.topic import Topic
from rowtide.spec import CHANGELOG_SCHEMA, USERS, USERS_ISO
from rowtide.streaming import streams
from tests.helpers import key, message, record, rows, topic_df, utc

OPS = "ucudu"


def slices(spark, count=4, size=30):
    """Topic segments of changes to ten keys."""
    for n in range(count):
        numbers = range(n * size, (n + 1) * size)
        yield topic_df(
            spark,
            *[record(i % 10 % 2, i, key(i % 10), message(i % 10, OPS[i % 7 % 5], name=str(i))) for i in numbers],
        )


def batch_state(spark, topic, tmp_path):
    raw, state = RawStore(spark, str(tmp_path / "batch_raw")), StateStore(spark, str(tmp_path / "batch"), USERS)
    jobs.land(topic.read(), raw)
    jobs.materialize(raw, state, USERS)
    return rows(state.current())


def test_stream_land_resumes(spark, tmp_path):
    topic, raw = Topic(spark, str(tmp_path / "t"), "users"), RawStore(spark, str(tmp_path / "raw"))
    total = 0
    for part in slices(spark):
        topic.append(part)
        total += 30
        streams.stream_land(streams.read_topic_stream(topic), raw, str(tmp_path / "ck")).awaitTermination()
        assert raw.read().count() == total
    streams.stream_land(streams.read_topic_stream(topic), raw, str(tmp_path / "ck")).awaitTermination()
    assert raw.records.numbers() == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="new checkpoint"):
        streams.stream_land(streams.read_topic_stream(topic), raw, str(tmp_path / "other"))
    assert rows(raw.read(), "partition", "offset") == rows(topic.read(), "partition", "offset")
    assert rows(raw.next_offsets()) == [(0, 119), (1, 120)]


def test_a_topic_may_be_empty_at_first(spark, tmp_path):
    topic, raw = Topic(spark, str(tmp_path / "t"), "users"), RawStore(spark, str(tmp_path / "raw"))
    running = streams.stream_land(
        streams.read_topic_stream(topic), raw, str(tmp_path / "ck"), {"processingTime": "1 second"}
    )
    try:
        running.processAllAvailable()
        assert raw.read().isEmpty()
        topic.append(next(slices(spark)))
        running.processAllAvailable()
    finally:
        running.stop()
    assert raw.read().count() == 30


def test_a_repeated_micro_batch_replaces_itself(spark, tmp_path):
    raw = RawStore(spark, str(tmp_path / "raw"))
    parts = [streams.decode(p) for p in slices(spark, 2)]
    for number, part in ((1, parts[0]), (2, parts[1]), (2, parts[1])):
        raw.append(part, number)
    assert raw.read().count() == 60
    assert rows(raw.next_offsets()) == [(0, 59), (1, 60)]


def test_stream_apply_equals_batch(spark, tmp_path):
    topic, state = Topic(spark, str(tmp_path / "t"), "users"), StateStore(spark, str(tmp_path / "s"), USERS)
    for part in slices(spark):
        topic.append(part)
        stream = streams.read_topic_stream(topic, files_per_batch=1)
        streams.stream_apply(stream, state, USERS, str(tmp_path / "ck")).awaitTermination()
    assert not state.fulls.numbers()
    assert rows(state.current()) == batch_state(spark, topic, tmp_path)


def test_replay_from_the_start_changes_nothing(spark, tmp_path):
    topic, state = Topic(spark, str(tmp_path / "t"), "users"), StateStore(spark, str(tmp_path / "s"), USERS)
    for part in slices(spark):
        topic.append(part)
    results = []
    for checkpoint in ("ck1", "ck2"):
        stream = streams.read_topic_stream(topic)
        streams.stream_apply(stream, state, USERS, str(tmp_path / checkpoint)).awaitTermination()
        results.append(rows(state.current()))
    assert results[0] == results[1] == batch_state(spark, topic, tmp_path)


def test_landed_records_as_a_stream(spark, tmp_path):
    topic, raw = Topic(spark, str(tmp_path / "t"), "users"), RawStore(spark, str(tmp_path / "raw"))
    state = StateStore(spark, str(tmp_path / "s"), USERS)
    for part in slices(spark, 2):
        topic.append(part)
        jobs.land(topic.read(), raw)
        streams.stream_apply(streams.read_raw_stream(raw), state, USERS, str(tmp_path / "ck")).awaitTermination()
    assert rows(state.current()) == batch_state(spark, topic, tmp_path)


def test_drain_keeps_polling(spark, tmp_path):
    """The drain runs until it is stopped and picks up what is added meanwhile."""
    topic, log_path = Topic(spark, str(tmp_path / "t"), "users"), str(tmp_path / "log")

    def add(*ids):
        changes = [(i, "users", "I", i, None, '{"name":"x"}', utc("2025-01-01"), False) for i in ids]
        spark.createDataFrame(changes, CHANGELOG_SCHEMA).write.mode("append").parquet(log_path)

    add(1, 2)
    stream = spark.readStream.schema(CHANGELOG_SCHEMA).parquet(log_path)
    running = streams.stream_drain(stream, topic, USERS_ISO, str(tmp_path / "ck"))
    try:
        running.processAllAvailable()
        add(3)
        running.processAllAvailable()
    finally:
        running.stop()
    assert rows(topic.read().select(F.col("key").cast("string"))) == [('{"id":1}',), ('{"id":2}',), ('{"id":3}',)]
