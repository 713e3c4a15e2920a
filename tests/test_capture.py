import os
import re
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rowtide.operators import audit
from rowtide.operators.capture import changelog_envelope, poll_envelope, snapshot_messages
from rowtide.plans import jobs
from rowtide.sources.changelog import (
    SentLog,
    captured,
    in_open_days,
    marked_ids,
    marks_of,
    missed,
    pending,
    purge_before,
    since,
    with_processed,
)
from rowtide.sources.jdbc import jdbc_options
from rowtide.sources.polled import Watermark, next_watermark, poll_changes
from rowtide.sources.topic import Topic
from rowtide.spec import CHANGELOG_SCHEMA, USERS, USERS_ISO
from tests.helpers import micros, plan, pushed_filters, rows, utc

AT = "2025-11-24 21:10:00"


def log_df(spark, *changes):
    return spark.createDataFrame(
        [(i, t, op, rid, old, new, utc(at), done) for i, t, op, rid, old, new, at, done in changes], CHANGELOG_SCHEMA
    )


def simple(spark, *ids, at=AT, done=False, table="users"):
    return log_df(spark, *[(i, table, "I", i, None, "{}", at, done) for i in ids])


def test_pending_is_oldest_first_with_the_id_deciding_ties(spark):
    log = simple(spark, 6, 5).union(simple(spark, 9, at="2025-11-24 21:09:59")).union(simple(spark, 1, done=True))
    assert [r["change_id"] for r in pending(log, limit=2).collect()] == [9, 5]
    sent = spark.createDataFrame([(5,)], "change_id long")
    assert [r["change_id"] for r in pending(log, sent, 10).collect()] == [9, 6]
    assert rows(pending(log, sent), "change_id") == [(6,), (9,)]


def test_envelope_images_and_defaults(spark):
    full = '{"id":1,"name":"a","email":"e","age":3,"created_at":"2025-11-24T20:00:00.5"}'
    log = log_df(
        spark,
        (1, "users", "I", 1, None, full, AT, False),
        (2, "users", "D", 1, full, None, AT, False),
        (3, "users", "U", 2, full, '{"id":2,"email":null,"age":"x"}', "2025-11-24 21:10:00.123456", False),
        (4, "users", "D", 3, None, None, AT, False),
        (5, "users", "I", 4, None, '{"created_at":""}', AT, False),
        (6, "users", "T", 5, full, full, AT, False),
    )
    got = {r["change_id"]: r for r in changelog_envelope(log, USERS_ISO).collect()}
    cols = ("ID", "name", "email", "age", "created_at", "__op", "__source_ts_ms", "__deleted")
    ms = micros(AT) // 1000
    assert [tuple(got[i][c] for c in cols) for i in range(1, 7)] == [
        (1, "a", "e", 3, "2025-11-24T20:00:00.5", "c", ms, "false"),
        (1, "a", "e", 3, "2025-11-24T20:00:00.5", "d", ms, "true"),
        (2, "", None, None, "2025-11-24T21:10:00.123456", "u", ms + 123, "false"),
        (3, "", "", None, "2025-11-24T21:10:00", "d", ms, "true"),
        (4, "", "", None, None, "c", ms, "false"),
        (5, "a", "e", 3, "2025-11-24T20:00:00.5", "T", ms, "false"),
    ]


def test_drain_marks_what_it_sent_and_no_more(spark, tmp_path):
    topic, sent = Topic(spark, str(tmp_path / "t"), "users"), SentLog(spark, str(tmp_path / "s"))
    log = simple(spark, *range(1, 251))
    for total in (100, 200, 250, 250):
        jobs.drain(log, sent, topic, USERS_ISO, limit=100)
        assert topic.read().count() == marked_ids(sent.read()).count() == total
    assert rows(audit.backlog(with_processed(log, sent.read()))) == [(True, 250)]
    assert len(topic.segments.numbers()) == len(sent.marks.numbers()) == 3


def test_a_lost_mark_repeats_messages_but_loses_none(spark, tmp_path):
    topic, sent = Topic(spark, str(tmp_path / "t"), "users"), SentLog(spark, str(tmp_path / "s"))
    jobs.drain(simple(spark, 1, 2), sent, topic, USERS_ISO)
    sent.marks.drop(sent.marks.numbers())
    jobs.drain(simple(spark, 1, 2, 3), sent, topic, USERS_ISO)
    assert topic.read().count() == 5
    assert rows(marked_ids(sent.read()), "change_id") == [(1,), (2,), (3,)]


def test_only_open_days_are_read(spark, tmp_path):
    path, sent = str(tmp_path / "log"), SentLog(spark, str(tmp_path / "s"))
    topic = Topic(spark, str(tmp_path / "t"), "users")
    log = simple(spark, 1, 2, at="2025-01-01 23:59:59").union(simple(spark, 3, at="2025-01-02 00:00:00"))
    log.write.parquet(path)
    jobs.drain(spark.read.parquet(path), sent, topic, USERS_ISO)
    assert rows(marked_ids(sent.read())) == [(1, 20089), (2, 20089), (3, 20090)]
    none, done = in_open_days(spark.read.parquet(path), sent.read())
    assert none.isEmpty() and done.isEmpty()
    # A late commit opens its day again, and only that.
    simple(spark, 4, at="2025-01-02 12:00:00").write.mode("append").parquet(path)
    log = spark.read.parquet(path)
    near, done = in_open_days(log, sent.read())
    assert rows(near, "change_id") == [(3,), (4,)] and rows(marked_ids(done), "change_id") == [(3,)]
    pushed = re.findall(r"PushedFilters: .*", pushed_filters(pending(near, done)))
    assert any("GreaterThanOrEqual(changed_at,2025-01-02" in x and "LessThan(changed_at,2025-01-03" in x for x in pushed)
    assert any("EqualTo(day,20090)" in x or "In(day, [20090])" in x for x in pushed)
    assert rows(jobs.drain(log, sent, topic, USERS_ISO), "change_id") == [(4,)]
    assert jobs.drain(log, sent, topic, USERS_ISO).isEmpty()


def test_changes_without_a_time_and_repeated_marks(spark):
    log = simple(spark, 1, 2, 3).union(log_df(spark, (9, "users", "I", 9, None, "{}", "2025-01-01", False)))
    log = log.withColumn("changed_at", F.expr("CASE WHEN change_id < 9 THEN changed_at END"))
    twice = marks_of(log.filter("change_id < 3")).unionByName(marks_of(log.filter("change_id = 1")))
    assert rows(pending(*in_open_days(log, twice)), "change_id") == [(3,), (9,)]
    assert pending(*in_open_days(log, twice.unionByName(marks_of(log)))).isEmpty()


def test_ids_far_apart_and_block_borders(spark):
    ids = [1, 2, 32_768, 32_769, 65_536, 65_537, 10**12, 2**62]
    log = simple(spark, *ids, 7, 32_770)
    marks = marks_of(log.filter(F.col("change_id").isin(ids)))
    assert marks.count() == 5
    assert rows(marked_ids(marks), "change_id") == sorted([(x,) for x in ids], key=str)
    assert rows(pending(log, marks), "change_id") == [(32_770,), (7,)]
    assert rows(with_processed(log, marks).filter("processed"), "change_id") == sorted([(x,) for x in ids], key=str)


def test_marks_of_ids_far_apart_hold_little(spark, tmp_path):
    # Each change is the only one of its day and block.
    log = simple(spark, 1).select("*", F.explode(F.sequence(F.lit(1), F.lit(300))).alias("n"))
    log = log.withColumns({"change_id": F.col("n") * 32_768, "changed_at": F.col("changed_at") + F.make_dt_interval("n")}).drop("n")
    marks = marks_of(log)
    assert marks.count() == 300
    # Whole bitmaps have 4 KB each.
    marks.cache().count()
    held = marks._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    marks.unpersist()
    assert held < 300 * 400
    assert pending(*in_open_days(log, marks)).isEmpty()


def test_marks_of_older_stores(spark, tmp_path):
    ids = [1, 2, 63, 64, 65, 32_768, 32_769, 65_537, 10**12, 0, -1, -40_000]
    log = simple(spark, *ids, 7, 32_770, -2)
    day_, id_ = F.lit(20089).cast("long").alias("day"), F.col("change_id")
    whole = log.filter(id_.isin(ids)).groupBy(day_, F.bitmap_bucket_number(id_).alias("block"))
    sent = SentLog(spark, str(tmp_path / "s"))
    sent.marks.write(whole.agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias("bits")))
    log = log.withColumn("changed_at", F.timestamp_seconds(day_ * 86_400))
    assert rows(pending(*in_open_days(log, sent.read())), "change_id") == [(-2,), (32_770,), (7,)]
    sent.mark(log)
    assert pending(*in_open_days(log, sent.read())).isEmpty()
    sent.close(20090)
    assert rows(with_processed(log, sent.read_all()).select("processed").distinct()) == [(True,)]


def test_closed_days_are_not_read(spark, tmp_path):
    path, sent = str(tmp_path / "log"), SentLog(spark, str(tmp_path / "s"))
    topic = Topic(spark, str(tmp_path / "t"), "users")
    log = simple(spark, 1, 2, at="2025-01-01 23:59:59").union(simple(spark, 3, at="2025-01-02 00:00:00"))
    log.write.parquet(path)
    with pytest.raises(ValueError, match="drain"):
        jobs.close_days(spark.read.parquet(path), sent, date(2025, 1, 2))
    jobs.drain(spark.read.parquet(path), sent, topic, USERS_ISO)
    jobs.close_days(spark.read.parquet(path), sent, date(2025, 1, 2))
    assert rows(marked_ids(sent.read())) == [(3, 20090)] and marked_ids(sent.read_all()).count() == 3
    scanned = " ".join(re.findall(r"PushedFilters: .*", pushed_filters(since(spark.read.parquet(path), sent.closed()))))
    assert "GreaterThanOrEqual(changed_at,2025-01-02" in scanned
    assert not any("folded" in x for x in sent.read().inputFiles())
    # One commits too late, one in time.
    simple(spark, 4, at="2025-01-01 12:00:00").union(simple(spark, 5, at="2025-01-02 12:00:00")).write.mode("append").parquet(path)
    log = spark.read.parquet(path)
    assert rows(jobs.drain(log, sent, topic, USERS_ISO), "change_id") == [(5,)]
    assert rows(missed(log, sent), "change_id") == [(4,)]
    assert rows(marked_ids(sent.read_all()), "change_id") == [(1,), (2,), (3,), (5,)]


def test_audit(spark):
    log = simple(spark, 1, 2, done=True).union(simple(spark, 3, at="2025-11-24 20:00:00"))
    log = log.union(simple(spark, 4, table="orders"))
    assert rows(audit.backlog(log)) == [(False, 2), (True, 2)]
    assert [r["change_id"] for r in audit.recent_changes(log, 2).collect()] == [4, 2]
    assert [r["change_id"] for r in audit.recent_changes(log, 2, "change_id").collect()] == [4, 3]
    assert rows(captured(log, ["orders"]), "change_id") == [(4,)]
    sent = spark.createDataFrame([(3,)], "change_id long")
    kept = purge_before(log, sent, F.lit(utc("2025-11-24 20:30:00")))
    assert rows(kept, "change_id", "processed") == [(1, True), (2, True), (4, False)]


POLLED = "ID long, name string, email string, age int, created_at timestamp, updated_at timestamp"


def polled(spark, *people):
    return spark.createDataFrame(
        [(i, "n", "e", 1, created and utc(created), utc(updated)) for i, created, updated in people], POLLED
    )


def test_poll_is_strict_and_overlap_is_not(spark):
    table = polled(spark, (1, AT, AT), (2, AT, "2025-11-24 21:10:00.000001"), (3, AT, "2025-11-24 21:09:00"))
    assert rows(poll_changes(table, utc(AT)), "ID") == [(2,)]
    assert rows(poll_changes(table, utc(AT), "0 seconds"), "ID") == [(1,), (2,)]
    assert rows(poll_changes(table, utc(AT), "1 minute"), "ID") == [(1,), (2,), (3,)]
    assert poll_changes(table, None).count() == 3


def test_poll_envelope(spark):
    table = polled(spark, (1, AT, AT), (2, None, AT), (3, AT, "2025-11-24 21:10:01"))
    us = micros(AT)
    assert rows(poll_envelope(table, USERS), "ID", "__op", "created_at", "__source_ts_ms", "__deleted") == [
        (1, "c", us, us, "false"), (2, "u", us, us, "false"), (3, "u", us, us + 1_000_000, "false")
    ]


def test_first_poll_starts_at_the_initial_watermark(spark, tmp_path):
    topic, mark = Topic(spark, str(tmp_path / "t"), "users"), Watermark(spark, str(tmp_path / "w"))
    table = polled(spark, (1, AT, AT), (2, AT, "2025-11-24 21:11:00"))
    sent = jobs.poll(table, mark, topic, USERS, initial_watermark=utc(AT))
    assert rows(sent, "ID") == [(2,)]
    assert mark.get() == utc("2025-11-24 21:11:00")


def test_rows_without_a_stamp_are_sent_by_the_first_poll(spark, tmp_path):
    topic, mark = Topic(spark, str(tmp_path / "t"), "users"), Watermark(spark, str(tmp_path / "w"))
    table = polled(spark, (1, AT, AT), (2, AT, AT)).withColumn(
        "updated_at", F.when(F.col("ID") == 1, F.col("updated_at"))
    )
    assert jobs.poll(table, mark, topic, USERS).count() == 2
    assert topic.read().filter("timestamp is null").isEmpty()
    assert mark.get() == utc(AT)
    assert jobs.poll(table, mark, topic, USERS).isEmpty()


def test_watermark_never_goes_back(spark, tmp_path):
    mark = Watermark(spark, str(tmp_path / "w"))
    assert mark.get() is None
    mark.save(next_watermark(polled(spark, (1, AT, AT)), None))
    assert mark.get() == utc(AT)
    earlier = polled(spark, (1, AT, "2025-11-24 20:00:00.000001"))
    mark.save(next_watermark(earlier, mark.get()))
    assert mark.get() == utc(AT)
    assert rows(next_watermark(earlier, utc(AT) + timedelta(microseconds=1)), "last_polled") == [
        ((utc(AT) + timedelta(microseconds=1)).replace(tzinfo=None),)
    ]


def test_poll_filter_reaches_the_source(spark, tmp_path):
    for kind in ("timestamp", "timestamp_ntz"):
        path = str(tmp_path / kind)
        polled(spark, (1, AT, AT)).withColumn("updated_at", F.col("updated_at").cast(kind)).write.parquet(path)
        text = plan(poll_changes(spark.read.parquet(path), utc(AT)))
        assert re.search(r"GreaterThan\(updated_at,2025-11-24.21:10", text)


def test_snapshot_messages(spark):
    table = polled(spark, (1, None, AT)).drop("updated_at")
    sent = snapshot_messages(table, USERS, F.lit(utc(AT))).first()
    assert sent["key"] == '{"id":1}'
    assert sent["value"] == (
        '{"id":1,"name":"n","email":"e","age":1,"created_at":null,"__op":"r",'
        f'"__source_ts_ms":{micros(AT) // 1000},"__deleted":"false"}}'
    )


def test_jdbc_options():
    """There is no database here, so only the options can be checked."""
    assert jdbc_options("jdbc:db://h/d", "users", "u", "p", split=("id", 0, 100, 4)) == {
        "url": "jdbc:db://h/d", "dbtable": "users", "user": "u", "password": "p", "fetchsize": "10000",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    assert "user" not in jdbc_options("jdbc:x", "t")


def test_the_watermark_reaches_the_scan_and_is_utc(spark, tmp_path):
    """A stored stamp is filtered in the source; a mark without a zone does not depend on the driver's."""
    path = str(tmp_path / "polled")
    spark.range(10).selectExpr("id", "timestamp_seconds(id * 3600) updated_at").write.parquet(path)
    table = spark.read.parquet(path)
    before = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        newer = poll_changes(table, datetime(1970, 1, 1, 5))
        assert newer.count() == 4
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThan(updated_at" in plan(newer)


def test_a_poll_without_stamps_saves_no_watermark(spark, tmp_path):
    mark = Watermark(spark, str(tmp_path / "w"))
    mark.save(spark.sql("select cast(null as timestamp) last_polled"))
    assert mark.get() is None
