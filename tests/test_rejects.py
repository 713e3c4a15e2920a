"""Counted quarantine in the jobs."""

from unittest.mock import patch

from rowtide.operators.parse import decode
from rowtide.plans import jobs
from rowtide.sources.raw import RawStore
from rowtide.sources.rejects import Rejects
from rowtide.sources.state import StateStore
from rowtide.spec import USERS
from rowtide.streaming import streams
from tests.helpers import key, message, raw_df, record, rows, topic_df

GOOD = [record(0, 0, key(1), message(1, "c", name="a")), record(0, 1, key(2), message(2, "u", name="b"))]
BAD = [
    record(0, 2, None, "{}"),
    record(0, 3, key(3), message(3, "t")),
    record(0, 4, None, '{"id":"abc","__op":"u"}'),
    record(0, 5, key(1), None),
]


def stores(spark, tmp_path):
    return (
        RawStore(spark, str(tmp_path / "raw")),
        StateStore(spark, str(tmp_path / "state"), USERS),
        Rejects(spark, str(tmp_path / "rejects")),
    )


def counts(rejects):
    return {x.kind: x.n for x in rejects.counts().collect()}


def test_a_run_keeps_and_counts_what_it_sets_aside(spark, tmp_path):
    raw, state, rejects = stores(spark, tmp_path)
    raw.append(raw_df(spark, *GOOD, *BAD))
    assert jobs.materialize(raw, state, USERS, rejects=rejects) == 1
    assert rows(rejects.read(), "offset", "reject") == [(2, "no_key"), (3, "unknown_op"), (4, "no_key")]
    assert counts(rejects) == {"accepted": 2, "no_key": 2, "unknown_op": 1, "tombstone": 1}
    assert rows(state.current(), "ID", "name") == [(1, "a"), (2, "b")]
    assert jobs.materialize(raw, state, USERS, rejects=rejects) is None
    assert counts(rejects)["no_key"] == 2


def test_a_run_without_rejects_reads_its_records_once(spark, tmp_path):
    raw, state, rejects = stores(spark, tmp_path)
    raw.append(raw_df(spark, *GOOD))
    with patch.object(rejects.records, "write") as write:
        jobs.materialize(raw, state, USERS, rejects=rejects)
    assert not write.called
    assert counts(rejects) == {"accepted": 2, "no_key": 0, "unknown_op": 0, "tombstone": 0}


def test_a_replay_replaces_the_rejects_of_earlier_runs(spark, tmp_path):
    raw, state, rejects = stores(spark, tmp_path)
    for part in (GOOD + BAD[:1], BAD[1:]):
        raw.append(raw_df(spark, *part))
        jobs.materialize(raw, state, USERS, rejects=rejects)
    before = rows(rejects.read()), counts(rejects)
    jobs.materialize(raw, state, USERS, mode="replay", rejects=rejects)
    assert (rows(rejects.read()), counts(rejects)) == before
    assert len(rejects.tallies.numbers()) == 1


def test_a_run_that_fails_at_its_rejects_is_not_applied(spark, tmp_path):
    raw, state, rejects = stores(spark, tmp_path)
    raw.append(raw_df(spark, *GOOD, *BAD))
    with patch.object(rejects.records, "write", side_effect=OSError("full")):
        try:
            jobs.materialize(raw, state, USERS, rejects=rejects)
        except OSError:
            pass
    assert not state.exists()
    jobs.materialize(raw, state, USERS, rejects=rejects)
    assert counts(rejects) == {"accepted": 2, "no_key": 2, "unknown_op": 1, "tombstone": 1}
    assert rejects.read().count() == 3


def test_bucketed_state(spark, tmp_path):
    raw, _, rejects = stores(spark, tmp_path)
    state = StateStore(spark, str(tmp_path / "bucketed"), USERS, buckets=2)
    raw.append(raw_df(spark, *GOOD, *BAD))
    jobs.materialize(raw, state, USERS, mode="replay", rejects=rejects)
    assert counts(rejects)["accepted"] == 2 and rejects.read().count() == 3


def test_stream(spark, tmp_path):
    _, state, rejects = stores(spark, tmp_path)
    source = str(tmp_path / "topic")
    topic_df(spark, *GOOD, *BAD).coalesce(1).write.parquet(source)
    records = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    for _ in range(2):
        streams.stream_apply(records, state, USERS, str(tmp_path / "checkpoint"), rejects=rejects).awaitTermination()
    assert counts(rejects) == {"accepted": 2, "no_key": 2, "unknown_op": 1, "tombstone": 1}
    assert rows(rejects.read(), "offset") == [(2,), (3,), (4,)]
    assert decode(spark.read.parquet(source)).count() == 6
