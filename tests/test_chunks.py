"""A snapshot in ranges of keys while the table changes, and the loop that drains."""

from datetime import timedelta
from itertools import islice

import pytest
from pyspark.sql import functions as F

from rowtide.plans import jobs
from rowtide.sources.changelog import SentLog
from rowtide.sources.chunks import ChunkProgress, in_range, key_ranges
from rowtide.sources.raw import RawStore
from rowtide.sources.state import StateStore
from rowtide.sources.topic import Topic
from rowtide.spec import CHANGELOG_SCHEMA, USERS
from tests.helpers import pushed_filters, rows, utc

T0 = utc("2025-01-01")


def minute(n):
    return T0 + timedelta(minutes=n)


class Source:
    """A table and its log; each look at either lets the next planned change commit."""

    def __init__(self, spark, users, plan=()):
        self.spark, self.users, self.plan, self.log = spark, dict(users), iter(plan), []

    def commit(self, operation, id, name, at):
        old, new = self.users.get(id), None if operation == "D" else name
        image = [None if x is None else f'{{"name": "{x}", "created_at": "2025-01-01T00:00:00"}}' for x in (old, new)]
        self.log.append((len(self.log) + 1, "users", operation, id, *image, at, False))
        self.users.pop(id, None)
        if new is not None:
            self.users[id] = new

    def _look(self):
        for change in islice(self.plan, 1):
            if change:
                self.commit(*change)

    def table(self):
        self._look()
        found = [(i, n, "e", 1, T0) for i, n in self.users.items()]
        return self.spark.createDataFrame(found, USERS.state_schema)

    def changelog(self):
        self._look()
        return self.spark.createDataFrame(self.log, CHANGELOG_SCHEMA)


class Flow:
    def __init__(self, spark, tmp_path, source):
        self.spark, self.source, self.path = spark, source, tmp_path
        self.topic = Topic(spark, str(tmp_path / "t"), "users")
        self.sent = SentLog(spark, str(tmp_path / "sent"))
        self.raw = RawStore(spark, str(tmp_path / "raw"))
        self.state = StateStore(spark, str(tmp_path / "s"), USERS)

    def snapshot(self, **options):
        progress = ChunkProgress(self.spark, str(self.path / "p"))
        return jobs.snapshot_chunks(
            self.source.table, self.source.changelog, progress, self.sent, self.topic, USERS, **options
        )

    def names(self):
        jobs.drain(self.source.changelog(), self.sent, self.topic, USERS)
        jobs.land(self.topic.read(), self.raw)
        jobs.materialize(self.raw, self.state, USERS)
        return dict(rows(self.state.current(), "ID", "name"))


USERS_THEN = {i: f"old{i}" for i in range(1, 9)}


@pytest.mark.parametrize("late", [0, 5])
def test_changes_between_the_marks_win(spark, tmp_path, late):
    # The looks: ranges; then for each range its low mark, its rows, its high mark.
    plan = [None, ("U", 1, "low", minute(1)), ("U", 2, "read", minute(2)), ("U", 3, "high", minute(3))]
    plan += [("D", 5, None, minute(4)), ("D", 6, None, minute(5)), ("D", 7, None, minute(6))]
    source = Source(spark, USERS_THEN, plan)
    flow = Flow(spark, tmp_path, source)
    assert flow.snapshot(chunks=2, late=timedelta(minutes=late)) == 0
    sent = {x.key.decode() for x in flow.topic.read().select("key").collect()}
    assert len(sent) < 8 + 1 and not any('"id":7}' in x for x in sent)  # its delete waits at the high mark
    assert flow.names() == source.users == {1: "low", 2: "read", 3: "high", 4: "old4", 8: "old8"}


def test_a_late_commit_after_the_snapshot_wins(spark, tmp_path):
    source = Source(spark, USERS_THEN)
    source.commit("U", 8, "eight", minute(10))
    flow = Flow(spark, tmp_path, source)
    assert flow.snapshot(chunks=3, late=timedelta(minutes=5)) == 0
    source.commit("U", 1, "late", minute(6))
    source.commit("D", 2, None, minute(7))
    assert flow.names() == source.users


def test_a_snapshot_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch):
    plan = [None] * 4 + [("U", 8, "new", minute(1)), None, ("I", 9, "nine", minute(2))]
    source = Source(spark, USERS_THEN, plan)
    flow = Flow(spark, tmp_path, source)
    assert flow.snapshot(chunks=4, most=1) == 3

    def broken(*_):
        raise OSError

    with monkeypatch.context() as patch:
        patch.setattr(ChunkProgress, "finish", broken)
        with pytest.raises(OSError):
            flow.snapshot(most=1)
    assert flow.names().keys() >= {1, 2, 3, 4}  # the range was sent, but is not marked
    source.commit("U", 3, "between", minute(3))
    assert flow.snapshot(most=1) == 2
    assert flow.snapshot() == 0 and flow.snapshot() == 0
    assert flow.names() == source.users


def test_closed_days_and_a_log_without_changes(spark, tmp_path):
    source = Source(spark, USERS_THEN)
    flow = Flow(spark, tmp_path, source)
    flow.snapshot(chunks=1, most=0)
    source.commit("U", 1, "one", T0)
    jobs.drain(source.changelog(), flow.sent, flow.topic, USERS)
    jobs.close_days(source.changelog(), flow.sent, minute(1440).date())
    assert flow.snapshot(late=timedelta(0)) == 0
    assert flow.names() == source.users
    assert rows(flow.topic.read().agg(F.max("timestamp"))) == [(minute(1440).replace(tzinfo=None),)]


def test_an_empty_table_has_one_open_range(spark, tmp_path):
    source = Source(spark, {})
    flow = Flow(spark, tmp_path, source)
    assert flow.snapshot(chunks=4) == 0
    source.commit("I", 1, "one", T0)
    assert flow.names() == {1: "one"}


def test_ranges_hold_every_key_once_and_reach_the_scan(spark, tmp_path):
    keys = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("ID"))
    found = key_ranges(keys, "ID", 8).collect()
    assert [x.chunk for x in found] == list(range(len(found))) and len(found) <= 8
    assert found[0].above is None and found[-1].upto is None
    assert [x.above for x in found[1:]] == [x.upto for x in found[:-1]]
    assert sum(in_range(keys, "ID", x).count() for x in found) == 1000
    keys.write.parquet(str(tmp_path / "keys"))
    plan = pushed_filters(in_range(spark.read.parquet(str(tmp_path / "keys")), "ID", found[1]))
    assert f"GreaterThan(ID,{found[1].above})" in plan and f"LessThanOrEqual(ID,{found[1].upto})" in plan
    nulls = spark.createDataFrame([(None,), (1,)], "ID long")
    assert [in_range(nulls, "ID", x).count() for x in key_ranges(nulls, "ID", 2).collect()] in ([1], [1, 0])


def test_the_drain_loop_pauses_by_what_it_found(spark, tmp_path):
    source = Source(spark, USERS_THEN)
    for n in range(5):
        source.commit("U", n + 1, f"new{n}", minute(n))
    flow, pauses = Flow(spark, tmp_path, source), []

    def pause(seconds):
        pauses.append(seconds)
        if len(pauses) == 4:
            source.commit("D", 8, None, minute(9))

    jobs.drain_loop(
        source.changelog, flow.sent, flow.topic, USERS, limit=2, go_on=lambda: len(pauses) < 6, pause=pause
    )
    assert pauses == [0.5, 0.5, 0.5, 2.0, 0.5, 2.0]
    assert flow.topic.read().count() == 6
