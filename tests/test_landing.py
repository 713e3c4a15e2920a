import json

import pytest
from pyspark.sql import functions as F

from rowtide.operators.audit import peek
from rowtide.operators.offsets import all_partitions, resume_offsets, since, starting_offsets_json
from rowtide.operators.parse import decode
from rowtide.plans import jobs
from rowtide.plans.jobs import land, materialize
from rowtide.session import scratch, work_dir
from rowtide.sources.batches import Batches
from rowtide.sources.changelog import SentLog
from rowtide.sources.polled import Watermark
from rowtide.sources.raw import RawStore
from rowtide.sources.state import StateStore
from rowtide.sources.topic import KafkaTopic, Topic, kafka_read_options, read_kafka, sendable, write_kafka
from rowtide.spec import USERS
from rowtide.streaming import streams
from tests.helpers import key, message, plan, record, rows, topic_df


def records(spark, partition, *offsets):
    return topic_df(spark, *[record(partition, n, key(n), message(n, "c")) for n in offsets])


def test_landing_resumes_per_partition(spark, tmp_path):
    raw = RawStore(spark, str(tmp_path / "raw"))
    first = records(spark, 0, 0, 1, 2).union(records(spark, 1, 0))
    assert land(first, raw) == 1
    assert rows(raw.next_offsets()) == [(0, 3), (1, 1)]
    assert land(first, raw) is None
    more = first.union(records(spark, 0, 3)).union(records(spark, 1, 1, 2)).union(records(spark, 3, 0, 1))
    assert land(more, raw) == 2  # partition 3 is new and is read from its start
    assert rows(raw.read(), "partition", "offset") == [
        (0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 1), (1, 2), (3, 0), (3, 1)
    ]
    assert rows(raw.next_offsets()) == [(0, 4), (1, 3), (3, 2)]
    assert land(more, raw) is None


def test_a_landing_reads_the_topic_once(spark, tmp_path):
    raw, read = RawStore(spark, str(tmp_path / "raw")), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    source = records(spark, 0, *range(40)).repartition(8)
    source = source.mapInPandas(count, source.schema)
    assert land(source, raw) == 1 and read.value == 40
    assert land(source, raw) is None and read.value == 80
    assert raw.records._glob("_writing/*") == []


def test_a_landing_has_as_many_files_as_told(spark, tmp_path):
    source = records(spark, 0, *range(40)).repartition(8)
    for files, most in ((None, 8), (2, 2)):
        raw = RawStore(spark, str(tmp_path / f"raw{files}"))
        land(source, raw, files)
        assert len(raw.records._glob("batch=*/part-*")) == most and raw.read().count() == 40


def test_landing_in_slices_equals_landing_once(spark, tmp_path):
    whole = records(spark, 0, *range(20)).union(records(spark, 1, *range(0, 40, 3)))
    once, sliced = RawStore(spark, str(tmp_path / "a")), RawStore(spark, str(tmp_path / "b"))
    land(whole, once)
    for upto in (3, 4, 11, 50):
        land(whole.filter(F.col("offset") < upto), sliced)
    assert rows(once.read()) == rows(sliced.read())
    assert rows(once.next_offsets()) == rows(sliced.next_offsets())


def test_landing_nothing(spark, tmp_path):
    raw = RawStore(spark, str(tmp_path / "raw"))
    assert land(records(spark, 0, 0).limit(0), raw) is None
    assert raw.read().isEmpty() and raw.next_offsets().isEmpty()


def test_resume_survives_lost_points(spark, tmp_path):
    """Points are written after the records; a job may die in between."""
    raw = RawStore(spark, str(tmp_path / "raw"))
    land(records(spark, 0, 0, 1), raw)
    raw.records.write(decode(records(spark, 0, 2, 3)))
    assert rows(raw.next_offsets()) == [(0, 4)]
    land(records(spark, 0, *range(6)), raw)
    assert rows(raw.read(), "offset") == [(n,) for n in range(6)]
    assert raw.points.kept.numbers() == [1, 3]
    left, _ = raw.read_since(spark.createDataFrame([(0, 2)], "partition int, next_offset long"))
    assert rows(left, "offset") == [(2,), (3,), (4,), (5,)]


def test_half_written_landing_is_not_read(spark, tmp_path):
    raw = RawStore(spark, str(tmp_path / "raw"))
    land(records(spark, 0, 0), raw)
    (tmp_path / "raw/version_1/batch=00000002").mkdir()
    assert rows(raw.read(), "offset") == [(0,)]
    assert land(records(spark, 0, 0, 1), raw) == 3


def test_versions_are_separate(spark, tmp_path):
    land(records(spark, 0, 0), RawStore(spark, str(tmp_path / "raw")))
    assert RawStore(spark, str(tmp_path / "raw"), version=2).read().isEmpty()
    assert (tmp_path / "raw/version_1").is_dir()


def test_distinct_records(spark, tmp_path):
    raw = RawStore(spark, str(tmp_path / "raw"))
    raw.append(decode(records(spark, 0, 0, 1)))
    raw.append(decode(records(spark, 0, 1, 2)))
    assert raw.read().count() == 4 and raw.distinct().count() == 3


def test_starting_offsets(spark):
    landed = decode(records(spark, 0, 4, 9).union(records(spark, 2, 7)))
    points = resume_offsets(landed)
    assert rows(starting_offsets_json(points, "users")) == [('{"users":{"0":10,"2":8}}',)]
    every = all_partitions(points, 4)
    assert rows(every) == [(0, 10), (1, -2), (2, 8), (3, -2)]
    assert rows(starting_offsets_json(every, "users")) == [('{"users":{"0":10,"1":-2,"2":8,"3":-2}}',)]
    assert rows(starting_offsets_json(points.limit(0), "users")) == [("earliest",)]


def test_since_skips_files_and_shuffles_nothing(spark, tmp_path):
    raw = RawStore(spark, str(tmp_path / "raw"))
    land(records(spark, 0, *range(10)).union(records(spark, 1, *range(5))), raw)
    text = plan(since(raw.read(), raw.next_offsets()))
    assert "GreaterThanOrEqual(offset,5)" in text
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_publish_gives_ordered_offsets(spark, tmp_path):
    topic = Topic(spark, str(tmp_path / "topic"), "t", partitions=3)
    for start in (0, 1000):
        messages = spark.range(start, start + 1000, numPartitions=7).select(
            F.col("id").alias("seq"),
            # Two thirds of the messages share one key.
            F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).cast("string").alias("key"),
            F.col("id").cast("string").alias("value"),
            F.current_timestamp().alias("timestamp"),
        )
        topic.publish(messages, ["seq"])
    by_partition = {}
    for r in decode(topic.read()).collect():
        by_partition.setdefault(r["partition"], []).append((r["offset"], int(r["message"]), r["key"]))
    assert sum(map(len, by_partition.values())) == 2000
    partition_of = {}
    for partition, sent in by_partition.items():
        sent.sort()
        assert len({o for o, _, _ in sent}) == len(sent)
        assert [m for _, m, _ in sent] == sorted(m for _, m, _ in sent)
        for _, _, k in sent:
            assert partition_of.setdefault(k, partition) == partition


def test_a_hot_key_is_spread_over_tasks(spark, tmp_path):
    messages = spark.range(0, 200_000, numPartitions=8).selectExpr(
        "id seq", "'k' key", "cast(id as string) value", "now() timestamp", "1 partition"
    )
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        sent = Topic(spark, str(tmp_path / "topic"), "t").publish(messages, ["seq"])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    value = F.col("value").cast("string").cast("long")
    ordered = [r[0] for r in sent.orderBy("offset").select(value).collect()]
    assert ordered == list(range(200_000))
    sizes = [r["count"] for r in sent.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 50_000


def test_messages_for_kafka_are_shuffled_only_where_a_key_has_an_order(spark):
    users = spark.createDataFrame([(1, "a", "e", 3, None), (2, "b", "f", 4, None)], USERS.state_schema)
    topic = KafkaTopic(spark, "h:9092", "t")
    made = {}

    def publish(rows, order, render, ordered=True):
        made[len(made)] = sendable(topic.messages(rows, render), order if ordered else None)
        return spark.createDataFrame([], "change_id long, ID long, updated_at timestamp")

    topic.publish = publish
    jobs.snapshot(users, topic, USERS)
    stamped = users.withColumn("updated_at", F.lit(None).cast("timestamp"))
    jobs.poll(stamped, Watermark(spark, scratch(spark, "mark")), topic, USERS)
    log = spark.sql(
        "select 7L change_id, 'users' table_name, 'D' operation, 2L record_id, '{}' old_data, "
        "cast(null as string) new_data, timestamp'2025-01-01' changed_at, false processed"
    )
    jobs.drain(log, SentLog(spark, scratch(spark, "sent")), topic, USERS)
    assert [x.columns for x in made.values()] == [["key", "value"]] * 3
    assert [x.count() for x in made.values()] == [2, 2, 1]
    assert ["Exchange" in plan(x) for x in made.values()] == [False, False, True]


def test_first_kafka_run_starts_at_the_beginning(spark, tmp_path):
    raw = RawStore(spark, str(tmp_path / "raw"))
    assert jobs.kafka_start(raw, "t", None) == "earliest"
    land(records(spark, 1, *range(5)), raw)
    assert json.loads(jobs.kafka_start(raw, "t", 3))["t"]["1"] == 5
    assert len(json.loads(jobs.kafka_start(raw, "t", 3))["t"]) == 3
    with pytest.raises(ValueError, match="number of partitions"):
        jobs.kafka_start(raw, "t", None)


def test_a_write_that_failed_half_way_is_seen_by_nobody(spark, tmp_path):
    topic = Topic(spark, str(tmp_path / "topic"), "t")
    topic.append(records(spark, 0, 0))
    half = tmp_path / "topic" / "_writing" / "segment=00000002"
    records(spark, 0, 1).write.parquet(str(half / "_temporary"))
    assert topic.read().count() == 1 and topic.segments.last() == 1
    stream = streams.read_topic_stream(topic)
    raw = RawStore(spark, str(tmp_path / "raw"))
    streams.stream_land(stream, raw, str(tmp_path / "ck")).awaitTermination()
    assert rows(raw.read(), "offset") == [(0,)]


def test_a_relative_path_is_the_working_directory(spark, tmp_path):
    here = Batches(spark, "some/folder", "id long").path
    assert here.startswith("file:") and here.endswith("/some/folder")


def test_null_keys_are_published(spark, tmp_path):
    topic = Topic(spark, str(tmp_path / "topic"), "t")
    messages = spark.range(3).selectExpr("id as seq", "cast(null as string) key", "'v' value", "now() timestamp")
    topic.publish(messages, ["seq"])
    assert rows(topic.read(), "key") == [(None,)] * 3
    assert topic.read().select("offset").distinct().count() == 3


def test_nothing_to_publish_leaves_no_segment(spark, tmp_path):
    topic = Topic(spark, str(tmp_path / "topic"), "t")
    messages = spark.range(0).selectExpr("id as seq", "'k' key", "'v' value", "now() timestamp")
    assert topic.publish(messages, ["seq"]).isEmpty()
    assert topic.segments.numbers() == []


def test_peek(spark):
    topic = records(spark, 1, 0, 1).union(records(spark, 0, *range(20)))
    assert rows(peek(topic, 3), "partition", "offset") == [(0, 0), (0, 1), (0, 2)]


def test_kafka_options(spark):
    """The connector is not on the class path here, so only its options can be checked."""
    assert kafka_read_options("h:9092", "t", '{"t":{"0":3}}') == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": '{"t":{"0":3}}'
    }
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka(spark, "h:9092", "t")
    with pytest.raises(Exception, match="(?i)kafka"):
        write_kafka(spark.range(1).selectExpr("'k' key", "'v' value", "id"), "h:9092", "t", ["id"])


def test_scratch_lies_in_the_shared_folder(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(work_dir(spark))


def test_read_since_opens_only_later_landings(spark, tmp_path):
    raw = RawStore(spark, str(tmp_path / "raw"))
    for upto in (2, 4, 6):
        land(records(spark, 0, *range(upto)).union(records(spark, 1, 0)), raw)
    points = spark.createDataFrame([(0, 3), (1, 1)], "partition int, next_offset long")
    left, reached = raw.read_since(points)
    assert rows(left, "partition", "offset") == [(0, 3), (0, 4), (0, 5)]
    assert rows(reached) == [(0, 6), (1, 1)]
    assert not any("batch=00000001" in f for f in left.inputFiles())
    left, reached = raw.read_since(reached)
    assert left.isEmpty() and rows(reached) == [(0, 6), (1, 1)]
    raw.records.write(decode(records(spark, 0, 6)))  # landed, but its points were not written
    left, reached = raw.read_since(spark.createDataFrame([(0, 6), (1, 1)], points.schema))
    assert rows(left, "offset") == [(6,)] and rows(reached) == [(0, 7), (1, 1)]


def test_unusable_records_are_not_read_again(spark, tmp_path):
    """What was read counts as applied, also where nothing of it could be used."""
    raw = RawStore(spark, str(tmp_path / "raw"))
    state = StateStore(spark, str(tmp_path / "state"), USERS)
    land(topic_df(spark, record(0, 0, key(1), message(1, "c")), record(1, 5, key(2), "oops")), raw)
    assert materialize(raw, state, USERS, "incremental") is not None
    assert rows(state.applied_offsets()) == [(0, 1), (1, 6)]
    assert materialize(raw, state, USERS, "incremental") is None
    assert materialize(raw, state, USERS, "replay") is not None
    assert rows(state.applied_offsets()) == [(0, 1), (1, 6)]
