"""Digest trees, capture lag, records that come twice."""

from unittest.mock import patch

from pyspark.sql import functions as F

from rowtide.operators import compare
from rowtide.operators.audit import capture_lag
from rowtide.operators.parse import decode, parse
from rowtide.sources.raw import RawStore
from rowtide.sources.state import StateStore
from rowtide.sources.topic import Topic
from rowtide.spec import USERS
from rowtide.streaming import streams
from tests.helpers import key, message, record, rows, topic_df

TABLE = "ID long, name string, email string, age int, created_at timestamp"


def users(spark, n, changed=()):
    return spark.createDataFrame([(i, None if i % 7 == 0 else f"n{i}", None, i if i in changed else 1, None) for i in range(n)], TABLE)


def test_digests_lead_to_what_differs_and_no_more(spark, tmp_path):
    state = StateStore(spark, str(tmp_path / "state"), USERS)
    state.load(users(spark, 3000))
    source = users(spark, 3001, changed={5, 1700}).filter("ID <> 9")
    want = rows(compare.reconcile(source, state.current(), "ID"))
    assert [x[1] for x in want] == ["different", "missing", "different", "extra"]
    with patch.object(compare, "reconcile", wraps=compare.reconcile) as joined:
        assert rows(compare.reconcile_digest(source, state.current(), "ID", state.digests())) == want
        near = joined.call_args.args
    assert all(x.count() < 60 for x in near[:2])
    with patch.object(compare, "reconcile", wraps=compare.reconcile) as joined:
        assert compare.reconcile_digest(users(spark, 3000), state.current(), "ID", state.digests()).isEmpty()
        assert joined.call_args.args[0].isEmpty()


def test_digests_see_where_a_null_is_and_other_types(spark):
    one = spark.createDataFrame([(1, None, "a")], "ID long, x string, y string")
    other = spark.createDataFrame([(1, "a", None)], "ID long, x string, y string")
    assert rows(compare.reconcile_digest(one, other, "ID")) == [(1, "different", "x,y")]
    narrow = spark.createDataFrame([(1, 5)], "ID int, n int")
    wide = spark.createDataFrame([(1, 5)], "ID long, n long")
    assert compare.reconcile_digest(narrow, wide, "ID").isEmpty()
    assert rows(compare.reconcile_digest(narrow.limit(0), wide, "ID")) == [(1, "extra", None)]


def test_digests_of_a_version_are_made_once(spark, tmp_path):
    state = StateStore(spark, str(tmp_path / "state"), USERS)
    state.load(users(spark, 50))
    first = rows(state.digests())
    with patch.object(state, "current") as current:
        assert rows(state.digests()) == first
    assert not current.called
    state.load(users(spark, 50, changed={3}))
    assert rows(state.digests()) != first


def at(second):
    return f"2025-01-01 00:{second // 60:02d}:{second % 60:02d}"


def lagging(spark, seconds):
    """Changes that reach the topic one, two, three ... seconds after their source time."""
    base = 1735689600000
    return topic_df(spark, *[record(0, n, key(n), message(n, "u", __source_ts_ms=base + 1000 * (s - n - 1)), at(s)) for n, s in enumerate(seconds)])


def test_lag_by_window(spark):
    found = capture_lag(parse(decode(lagging(spark, [10, 20, 50, 70])), USERS), "1 minute")
    assert rows(found, "n", "p50", "p95", "p99", "most") == [(1, 4000, 4000, 4000, 4000), (3, 2000, 3000, 3000, 3000)]
    none = topic_df(spark, record(0, 0, key(1), message(1, "u")))
    assert capture_lag(parse(decode(none), USERS)).isEmpty()


def test_lag_as_a_stream_gives_closed_windows(spark, tmp_path):
    topic = Topic(spark, str(tmp_path / "t"), "users")
    records = lagging(spark, [10, 20, 50, 70, 500])
    topic.append(records)
    stream = streams.read_topic_stream(topic)
    out = str(tmp_path / "lag")
    streams.stream_lag(stream, USERS, out, str(tmp_path / "c"), "1 minute", "2 minutes").awaitTermination()
    batch = capture_lag(parse(decode(records), USERS), "1 minute").filter(F.col("start") < "2025-01-01 00:02:00")
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_records_that_come_again_land_once(spark, tmp_path):
    topic, raw = Topic(spark, str(tmp_path / "t"), "users"), RawStore(spark, str(tmp_path / "raw"))
    old, new = record(0, 0, key(1), message(1, "c"), "2001-01-01 00:00:00"), record(0, 1, key(2), message(2, "c"))
    for part in ([old, old], [old, new], [new, record(1, 0, key(3), message(3, "c"), "1999-01-01 00:00:00")]):
        topic.append(topic_df(spark, *part).coalesce(1))
    checkpoint = str(tmp_path / "c")
    stream = streams.read_topic_stream(topic, files_per_batch=1)
    streams.stream_land(stream, raw, checkpoint, repeats_within="1 hour").awaitTermination()
    assert rows(raw.read(), "partition", "offset") == [(0, 0), (0, 1), (1, 0)]
    # What is remembered outlives the query.
    topic.append(topic_df(spark, old, record(1, 1, key(4), message(4, "c"))))
    streams.stream_land(stream, raw, checkpoint, repeats_within="1 hour").awaitTermination()
    assert rows(raw.read(), "partition", "offset") == [(0, 0), (0, 1), (1, 0), (1, 1)]
