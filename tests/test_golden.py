"""The users scenario, end to end, for each way of capturing changes."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rowtide.operators.compare import diff_snapshots, reconcile
from rowtide.operators.parse import decode, parse, unwrap
from rowtide.plans import jobs
from rowtide.sources.changelog import SentLog, marked_ids
from rowtide.sources.polled import Watermark
from rowtide.sources.raw import RawStore
from rowtide.sources.state import StateStore
from rowtide.sources.topic import Topic
from rowtide.spec import USERS, USERS_ISO
from tests.helpers import rows, topic_df, record, utc

USERS_SCHEMA = "ID long, name string, email string, age int, created_at timestamp"
T0, T1 = utc("2025-11-24 20:56:30.123456"), utc("2025-11-24 21:10:00")
JOHN = (1001, "John Doe", "john@example.com", 30, T0)
JANE = (1002, "Jane Smith", "jane@example.com", 25, T0)
NEW = (1003, "New User", "newuser@example.com", 28, T1)
JOHN2 = (1001, "John Doe", "john.updated@example.com", 31, T0)
AFTER = [(1001, "john.updated@example.com", 31), (1003, "newuser@example.com", 28)]


class Flow:
    """Topic, raw store and state of one capture."""

    def __init__(self, spark, tmp_path, spec, partitions=3):
        self.spec = spec
        self.topic = Topic(spark, str(tmp_path / "topic"), "users", partitions)
        self.raw = RawStore(spark, str(tmp_path / "raw"))
        self.state = StateStore(spark, str(tmp_path / "state/users"), spec)

    def sync(self, mode):
        jobs.land(self.topic.read(), self.raw)
        jobs.materialize(self.raw, self.state, self.spec, mode)

    def ops(self):
        parsed = parse(decode(self.topic.read()), self.spec)
        return sorted(r["__op"] + str(r["ID"]) for r in parsed.collect())


@pytest.mark.parametrize("mode", ["replay", "incremental"])
def test_log_capture(spark, tmp_path, mode):
    flow = Flow(spark, tmp_path, USERS)
    jobs.snapshot(spark.createDataFrame([JOHN, JANE], USERS_SCHEMA), flow.topic, USERS, F.lit(T0))
    flow.sync(mode)
    assert rows(flow.state.current()) == [
        tuple(v if i < 4 else v.replace(tzinfo=None) for i, v in enumerate(r)) for r in (JOHN, JANE)
    ]
    nested = [
        (1, '{"id":1003}', '{"before":null,"after":{"id":1003,"name":"New User","email":"newuser@example.com",'
            '"age":28,"created_at":1764018600000000},"source":{"ts_ms":1764018600000},"op":"c"}'),
        (2, '{"id":1001}', '{"before":{"id":1001},"after":{"id":1001,"name":"John Doe",'
            '"email":"john.updated@example.com","age":31,"created_at":1764017790123456},'
            '"source":{"ts_ms":1764018600000},"op":"u"}'),
        (3, '{"id":1002}', '{"before":{"id":1002,"name":"Jane Smith","email":"jane@example.com","age":25,'
            '"created_at":1764017790123456},"after":null,"source":{"ts_ms":1764018600000},"op":"d"}'),
        (4, '{"id":1002}', None),
    ]
    envelopes = topic_df(spark, *[record(0, 100 + n, k, v, "2025-11-24 21:10:00") for n, k, v in nested])
    flat = unwrap(decode(envelopes), USERS)
    flow.topic.publish(
        flat.select("offset", "key", F.col("message").alias("value"), F.col("kafka_timestamp").alias("timestamp"))
        .withColumnRenamed("offset", "lsn"),
        ["lsn"],
    )
    flow.sync(mode)
    assert flow.ops() == ["c1003", "d1002", "r1001", "r1002", "u1001"]
    assert rows(flow.state.current(), "ID", "email", "age") == AFTER
    flow.sync(mode)
    assert rows(flow.state.current(), "ID", "email", "age") == AFTER


@pytest.mark.parametrize("mode", ["replay", "incremental"])
def test_trigger_capture(spark, tmp_path, mode):
    """The change log comes from comparing snapshots, as row triggers would fill it."""
    flow = Flow(spark, tmp_path, USERS_ISO)
    sent = SentLog(spark, str(tmp_path / "sent"))
    versions = [[], [JOHN, JANE], [JOHN2, NEW]]
    log = None
    for step in (1, 2):
        before, after = (spark.createDataFrame(versions[i], USERS_SCHEMA) for i in (step - 1, step))
        changed = F.lit(T0 if step == 1 else T1)
        diff = diff_snapshots(before, after, "ID", "users", changed)
        # The images use the JSON names of the message, not the column names.
        for image in ("old_data", "new_data"):
            diff = diff.withColumn(image, F.regexp_replace(image, '"ID"', '"id"'))
        number = F.row_number().over(Window.orderBy("record_id")) - 1 + 100 * step
        part = diff.withColumn("change_id", number.cast("long"))
        log = part if log is None else log.unionByName(part)
        jobs.drain(log, sent, flow.topic, USERS_ISO, limit=100)
        flow.sync(mode)
    assert flow.ops() == ["c1001", "c1002", "c1003", "d1002", "u1001"]
    assert rows(flow.state.current(), "ID", "email", "age") == AFTER
    assert rows(marked_ids(sent.read()), "change_id") == [(100,), (101,), (200,), (201,), (202,)]
    assert jobs.drain(log, sent, flow.topic, USERS_ISO).count() == 0
    assert flow.topic.read().count() == 5


@pytest.mark.parametrize("mode", ["replay", "incremental"])
def test_polling_capture(spark, tmp_path, mode):
    """A poll sees no deletes: the removed row stays in the state."""
    schema = USERS_SCHEMA + ", updated_at timestamp"
    flow = Flow(spark, tmp_path, USERS)
    mark = Watermark(spark, str(tmp_path / "watermark"))
    first = spark.createDataFrame([(*JOHN, T0), (*JANE, T0)], schema)
    second = spark.createDataFrame([(*JOHN2, T1), (*NEW, T1)], schema)
    jobs.poll(first, mark, flow.topic, USERS)
    assert flow.topic.read().count() == 2
    assert mark.get() == T0
    flow.sync(mode)
    jobs.poll(second, mark, flow.topic, USERS)
    assert flow.topic.read().count() == 4
    assert mark.get() == T1
    flow.sync(mode)
    assert flow.ops() == ["c1001", "c1002", "c1003", "u1001"]
    assert rows(flow.state.current(), "ID", "email", "age") == [
        AFTER[0], (1002, "jane@example.com", 25), AFTER[1]
    ]
    assert jobs.poll(second, mark, flow.topic, USERS).count() == 0
    assert mark.get() == T1
    source = second.drop("updated_at")
    assert rows(reconcile(source, flow.state.current(), "ID")) == [(1002, "extra", None)]
