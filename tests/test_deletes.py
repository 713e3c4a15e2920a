"""Deletes of a polled table, and files of even size."""

import os
from pathlib import Path

from pyspark.sql import functions as F

from rowtide.operators.parse import changes, decode
from rowtide.plans import jobs
from rowtide.sources.polled import Watermark
from rowtide.sources.raw import RawStore
from rowtide.sources.state import StateStore
from rowtide.sources.topic import Topic
from rowtide.spec import USERS
from tests.helpers import plan, rows, utc

SCHEMA = "ID long, name string, email string, age int, created_at timestamp, updated_at timestamp, gone boolean"
T0, T1, T2 = utc("2025-01-01"), utc("2025-01-02"), utc("2025-01-03")


def table(spark, *found):
    return spark.createDataFrame([(i, "n", "e", 1, T0, at, gone) for i, at, gone in found], SCHEMA)


def flow(spark, tmp_path):
    topic, mark = Topic(spark, str(tmp_path / "t"), "users"), Watermark(spark, str(tmp_path / "w"))
    raw, state = RawStore(spark, str(tmp_path / "raw")), StateStore(spark, str(tmp_path / "s"), USERS)

    def sync():
        jobs.land(topic.read(), raw)
        jobs.materialize(raw, state, USERS)
        return [x[0] for x in rows(state.current(), "ID")]

    return topic, mark, state, sync


def test_marked_and_removed_rows(spark, tmp_path):
    topic, mark, state, sync = flow(spark, tmp_path)
    jobs.poll(table(spark, *[(i, T0, None) for i in range(1, 6)]), mark, topic, USERS, deleted="gone")
    assert sync() == [1, 2, 3, 4, 5]
    left = table(spark, (1, T0, False), (2, T1, True), (3, T1, None), (6, T1, False))
    jobs.poll(left, mark, topic, USERS, deleted="gone")
    sent = jobs.poll_deletes(left, state, topic, USERS, F.lit(T2))
    assert rows(sent, "ID") == [(4,), (5,)]
    assert sync() == [1, 3, 6]
    assert jobs.poll_deletes(left, state, topic, USERS, F.lit(T2)).isEmpty()
    # A row that comes back has a later stamp, so it wins over its delete.
    back = table(spark, (1, T0, None), (3, T1, None), (4, utc("2025-01-04"), None), (6, T1, None))
    jobs.poll(back, mark, topic, USERS, deleted="gone")
    assert sync() == [1, 3, 4, 6]
    ops = changes(decode(topic.read()), USERS).groupBy("ID").agg(F.sort_array(F.collect_list("__op")).alias("ops"))
    assert {x.ID: x.ops for x in ops.collect()}[2] == ["c", "d"]


def test_an_empty_table_deletes_all_and_an_empty_state_none(spark, tmp_path):
    topic, mark, state, sync = flow(spark, tmp_path)
    none = table(spark)
    assert jobs.poll_deletes(none, state, topic, USERS).isEmpty()
    jobs.poll(table(spark, (1, T0, None), (2, T0, None)), mark, topic, USERS)
    sync()
    jobs.poll_deletes(none, state, topic, USERS)
    assert sync() == []


def test_only_keys_are_compared(spark, tmp_path):
    found = str(tmp_path / "found")
    table(spark, (1, T0, None)).write.parquet(found)
    state = StateStore(spark, str(tmp_path / "s"), USERS)
    state.load(spark.read.parquet(found).select(*USERS.columns))
    gone = state.current().select("ID").join(spark.read.parquet(found).select("ID"), "ID", "left_anti")
    assert "email" not in plan(gone)


def sizes(path):
    return [os.path.getsize(x) for x in Path(str(path).removeprefix("file:")).rglob("*.parquet")]


def test_even_files(spark, tmp_path):
    """Few partitions with nearly all rows, and many with next to none."""
    message = F.sha2(F.col("id").cast("string"), 512)
    big = spark.range(0, 20_000, 1, 8).select(F.lit(0).alias("partition"), F.col("id").alias("offset"), message.alias("v"))
    small = spark.range(0, 40, 1, 40).select(F.lit(1).alias("partition"), F.col("id").alias("offset"), message.alias("v"))
    records = big.unionAll(small).select(
        F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), F.lit("t").alias("topic"),
        F.col("partition").cast("int").alias("partition"), "offset", F.lit(T0).alias("timestamp"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    try:
        as_it_is, even = (RawStore(spark, str(tmp_path / x)) for x in ("skewed", "even"))
        jobs.land(records, as_it_is)
        jobs.land(records, even, even=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(sizes(as_it_is.path)) > 30 and max(sizes(as_it_is.path)) > 100 * min(sizes(as_it_is.path))
    found = sizes(even.path)
    assert 3 <= len(found) <= 12 and max(found) < 5 * min(found)
    assert even.read().count() == as_it_is.read().count() == 20_040
    state = StateStore(spark, str(tmp_path / "s"), USERS, even=True)
    users = spark.range(0, 100, 1, 50).selectExpr("id ID", "'a' name", "'e' email", "1 age", "timestamp'2025-01-01' created_at")
    state.load(users)
    assert len(sizes(tmp_path / "s" / "full=00000001")) == 1 and state.current().count() == 100
