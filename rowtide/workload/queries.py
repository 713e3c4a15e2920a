"""One query per operator, each over whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.functions.ops import envelope_op
from rowtide.functions.times import from_iso, from_micros
from rowtide.operators import audit
from rowtide.operators.capture import (
    changelog_envelope,
    changelog_messages,
    poll_envelope,
    poll_messages,
    render_envelope,
    snapshot_messages,
    with_key,
)
from rowtide.operators.compare import diff_snapshots, reconcile, reconcile_counts
from rowtide.operators.compare import reconcile_digest as by_digest
from rowtide.operators.latest import latest_per_key
from rowtide.operators.merge import absorb, apply_changes, merge_actions, stored_rows
from rowtide.operators.offsets import all_partitions, resume_offsets, starting_offsets_json
from rowtide.operators.parse import accepted, changes, decode, parse, quarantined, unwrap, with_order
from rowtide.plans import jobs
from rowtide.session import scratch, utc
from rowtide.sources.changelog import SentLog, captured, missed, pending, purge_before, with_processed
from rowtide.sources.chunks import ChunkProgress
from rowtide.sources.polled import Watermark, next_watermark, poll_changes
from rowtide.sources.raw import RawStore
from rowtide.sources.rejects import Rejects
from rowtide.sources.state import StateStore
from rowtide.sources.topic import Topic
from rowtide.spec import DELETE, ISO, MICROS, Field, TableSpec
from rowtide.streaming import streams
from rowtide.workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its function's name; it runs with session times in UTC."""
    QUERIES[run.__name__] = lambda spark, sf_dir: run(utc(spark), sf_dir)
    return run


POLLED_AT = datetime.fromisoformat(t.ORDERS_CUT).replace(tzinfo=UTC)


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(t.events_topic(spark, sf_dir))


# -- landing ------------------------------------------------------------------------------


@query
def resume_points(spark, sf_dir):
    return resume_offsets(_raw_events(spark, sf_dir))


@query
def resume_points_all(spark, sf_dir):
    """Two topic partitions have not landed anything yet."""
    return all_partitions(resume_offsets(_raw_events(spark, sf_dir)), t.TOPIC_PARTITIONS + 2)


@query
def starting_offsets(spark, sf_dir):
    points = all_partitions(resume_offsets(_raw_events(spark, sf_dir)), t.TOPIC_PARTITIONS + 2)
    return starting_offsets_json(points, "events")


def _landed_twice(spark, sf_dir) -> RawStore:
    topic = Topic(spark, scratch(spark, "topic"), "events")
    raw = RawStore(spark, scratch(spark, "raw"))
    records = t.events_topic(spark, sf_dir)
    early = F.col("timestamp") < t.at(t.EVENTS_CUT)
    topic.append(records.filter(early))
    jobs.land(topic.read(), raw)
    topic.append(records.filter(~early))
    jobs.land(topic.read(), raw)
    return raw


@query
def land_incremental(spark, sf_dir):
    """What the second of two landings adds."""
    raw = _landed_twice(spark, sf_dir)
    return raw.records.read(after=1).select("partition", "offset", "key", "kafka_timestamp")


@query
def land_slices(spark, sf_dir):
    """The raw store after two landings holds each record once."""
    return _landed_twice(spark, sf_dir).read().select("partition", "offset", "key", "kafka_timestamp")


@query
def topic_peek(spark, sf_dir):
    first = audit.peek(t.events_topic(spark, sf_dir), 10)
    return decode(first).select("partition", "offset", "key", "kafka_timestamp")


@query
def publish_order(spark, sf_dir):
    """Messages of a partition in the order of their offsets, which have gaps, counted from 0."""
    rows = with_key(t.event_rows(spark, sf_dir).withColumnRenamed("offset", "event_id"), "id", t.EVENT_SPEC)
    topic = Topic(spark, scratch(spark, "topic"), "events")
    sent = topic.publish(rows, ["kafka_timestamp", "event_id"], t.event_messages)
    place = F.row_number().over(Window.partitionBy("partition").orderBy("offset")) - 1
    return sent.select("event_id", "partition", place.cast("long").alias("offset"))


# -- parsing ------------------------------------------------------------------------------


@query
def parse_envelope(spark, sf_dir):
    return changes(_raw_events(spark, sf_dir), t.EVENT_SPEC)


@query
def parse_iso_envelope(spark, sf_dir):
    """Change-log messages: ISO times, captured defaults and the optional fields."""
    envelope = changelog_envelope(t.order_changelog(spark, sf_dir), t.ORDER_SPEC)
    sent = render_envelope(envelope, t.ORDER_SPEC, "changed_at", "change_id")
    raw = sent.select(
        F.lit(0).alias("partition"),
        F.col("change_id").alias("offset"),
        "key",
        F.col("value").alias("message"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    return parse(raw, t.ORDER_SPEC).filter("reject IS NULL").drop("partition", "key", "message", "reject")


@query
def quarantine(spark, sf_dir):
    return quarantined(parse(decode(t.faulty_topic(spark, sf_dir)), t.EVENT_SPEC)).select(
        "partition", "offset", "reject"
    )


@query
def accepted_of_faulty(spark, sf_dir):
    """What is left after faulty records and tombstones are set aside."""
    return accepted(parse(decode(t.faulty_topic(spark, sf_dir)), t.EVENT_SPEC), t.EVENT_SPEC)


def _landed_faults(spark, sf_dir) -> tuple[RawStore, StateStore, Rejects]:
    """Faulty records in two landings, each applied by a run of its own."""
    raw = RawStore(spark, scratch(spark, "raw"))
    state = StateStore(spark, scratch(spark, "state"), t.EVENT_SPEC)
    rejects = Rejects(spark, scratch(spark, "rejects"))
    records = t.faulty_topic(spark, sf_dir)
    early = F.col("timestamp") < t.at(t.EVENTS_CUT)
    for landing in (records.filter(early), records.filter(~early)):
        raw.append(decode(landing))
        jobs.materialize(raw, state, t.EVENT_SPEC, rejects=rejects)
    return raw, state, rejects


@query
def materialize_quarantine(spark, sf_dir):
    """What two runs of the job set aside, and the count of its reason in both, by the job's own counters."""
    _, _, rejects = _landed_faults(spark, sf_dir)
    kept = rejects.read().select("partition", "offset", "reject")
    return kept.join(F.broadcast(rejects.counts()), F.col("reject") == F.col("kind")).drop("kind")


@query
def materialize_counts(spark, sf_dir):
    """Records of each kind that the two runs have counted while they made the state."""
    _, _, rejects = _landed_faults(spark, sf_dir)
    return rejects.counts()


@query
def state_new_column(spark, sf_dir):
    """A state whose spec gains a column between two landings, and is compacted by a job that does not know it yet."""
    fields = {name: field for name, field in t.EVENT_SPEC.fields.items() if name != "value"}
    older = replace(t.EVENT_SPEC, fields=fields)
    raw, path = RawStore(spark, scratch(spark, "raw")), scratch(spark, "state")
    records = t.events_topic(spark, sf_dir)
    early = F.col("timestamp") < t.at(t.EVENTS_CUT)
    raw.append(decode(records.filter(early)))
    jobs.materialize(raw, StateStore(spark, path, older), older, "replay")
    raw.append(decode(records.filter(~early)))
    jobs.materialize(raw, StateStore(spark, path, t.EVENT_SPEC), t.EVENT_SPEC)
    StateStore(spark, path, older).compact()
    return StateStore(spark, path, t.EVENT_SPEC).current()


@query
def unwrap_nested(spark, sf_dir):
    flat = unwrap(decode(t.nested_topic(spark, sf_dir)), t.EVENT_SPEC)
    return parse(flat, t.EVENT_SPEC).drop("key", "message", "reject")


@query
def time_parse(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")

    def iso(pattern: str):
        return from_iso(F.date_format(ts, pattern))

    return t.read(spark, sf_dir, "events").select(
        "event_id",
        from_micros(F.unix_micros(ts)).alias("exact"),
        from_micros(F.unix_micros(ts), "second").alias("whole_second"),
        iso("yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso_micros"),
        iso("yyyy-MM-dd'T'HH:mm:ss.SSSS").alias("iso_short"),
        iso("yyyy-MM-dd'T'HH:mm:ss").alias("iso_plain"),
        iso("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("iso_zone"),
        from_iso(F.lit("")).alias("iso_empty"),
        iso("HH:mm").alias("iso_time"),
        iso("yyyy").alias("iso_year"),
        iso("yyyy-MM-dd").alias("iso_day"),
        from_iso(F.col("event_type")).alias("iso_junk"),
    )


# -- latest and merge ---------------------------------------------------------------------


@query
def latest_change(spark, sf_dir):
    return latest_per_key(changes(_raw_events(spark, sf_dir), t.EVENT_SPEC), "id")


@query
def latest_order(spark, sf_dir):
    """Equal times within a key are decided by partition and offset."""
    return latest_per_key(t.order_rows(spark, sf_dir), "id")


@query
def latest_by_offset(spark, sf_dir):
    """Ranked by place in the topic alone, whatever the record times."""
    rows = t.event_rows(spark, sf_dir).withColumn("kafka_timestamp", t.at(t.EVENTS_CUT))
    return latest_per_key(rows, "id", ("partition", "offset"))


@query
def initial_state(spark, sf_dir):
    latest = latest_per_key(changes(_raw_events(spark, sf_dir), t.EVENT_SPEC), "id")
    return latest.filter(F.col("__op") != DELETE).select(*t.EVENT_SPEC.columns)


@query
def tombstone_delete(spark, sf_dir):
    latest = latest_per_key(
        changes(decode(t.tombstone_topic(spark, sf_dir)), t.EVENT_SPEC, tombstones="delete"), "id"
    )
    return latest.filter(F.col("__op") != DELETE).select(*t.EVENT_SPEC.columns)


@query
def tombstone_ignore(spark, sf_dir):
    latest = latest_per_key(changes(decode(t.tombstone_topic(spark, sf_dir)), t.EVENT_SPEC), "id")
    return latest.filter(F.col("__op") != DELETE).select(*t.EVENT_SPEC.columns)


def _orders_split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The state before the cut, and the latest change per key from the cut on."""
    rows = t.order_rows(spark, sf_dir)
    early = F.col("kafka_timestamp") < t.at(t.ORDERS_CUT)
    state = latest_per_key(rows.filter(early), "id").filter(F.col("__op") != DELETE)
    return state.select(*t.ORDER_SPEC.columns), latest_per_key(rows.filter(~early), "id")


@query
def merge_apply(spark, sf_dir):
    state, incoming = _orders_split(spark, sf_dir)
    return apply_changes(state, incoming, t.ORDER_SPEC)


@query
def merge_lookup(spark, sf_dir):
    """The same merge by a state table without history: the changes are written beside the
    state and looked up when it is read."""
    state, incoming = _orders_split(spark, sf_dir)
    store = StateStore(spark, scratch(spark, "state"), t.ORDER_SPEC)
    store.load(state)
    store.apply(with_order(incoming))
    return store.current()


@query
def merge_action_counts(spark, sf_dir):
    state, incoming = _orders_split(spark, sf_dir)
    return merge_actions(state, incoming, t.ORDER_SPEC)


@query
def late_changes(spark, sf_dir):
    """Changes absorbed newest first: the late, older half must not win or revive a key."""
    rows = t.order_rows(spark, sf_dir)
    early = F.col("kafka_timestamp") < t.at(t.ORDERS_CUT)
    older, newer = (
        stored_rows(with_order(latest_per_key(half, "id")), t.ORDER_SPEC)
        for half in (rows.filter(early), rows.filter(~early))
    )
    merged = absorb(newer, older, t.ORDER_SPEC)
    return merged.filter(~F.col("_deleted")).select(*t.ORDER_SPEC.columns)


# -- change log ---------------------------------------------------------------------------


def _partly_sent(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The change log, and the ids of the changes before the cut as already sent."""
    log = t.order_changelog(spark, sf_dir)
    return log, log.filter(F.col("changed_at") < t.at(t.ORDERS_CUT)).select("change_id")


@query
def changelog_pending(spark, sf_dir):
    """The oldest hundred waiting changes."""
    log, sent = _partly_sent(spark, sf_dir)
    return pending(log, sent, 100).select("change_id", "operation", "record_id", "changed_at")


@query
def changelog_pending_all(spark, sf_dir):
    log, sent = _partly_sent(spark, sf_dir)
    return pending(log, sent).select("change_id", "operation", "record_id", "changed_at")


@query
def changelog_to_envelope(spark, sf_dir):
    return changelog_envelope(t.order_changelog(spark, sf_dir), t.ORDER_SPEC)


@query
def backlog(spark, sf_dir):
    return audit.backlog(with_processed(*_partly_sent(spark, sf_dir)))


@query
def recent_changes(spark, sf_dir):
    log = t.order_changelog(spark, sf_dir)
    return audit.recent_changes(log, 10).select("change_id", "operation", "record_id", "changed_at")


@query
def recent_change_ids(spark, sf_dir):
    log = t.order_changelog(spark, sf_dir)
    return audit.recent_changes(log, 10, "change_id").select("change_id", "operation", "record_id")


@query
def captured_tables(spark, sf_dir):
    log = captured(t.order_changelog(spark, sf_dir), ["orders_1", "orders_2"])
    return log.select("change_id", "table_name", "operation", "record_id")


@query
def purged_log(spark, sf_dir):
    log, sent = _partly_sent(spark, sf_dir)
    kept = purge_before(log, sent, t.at("1999-01-01 00:00:00"))
    return kept.select("change_id", "changed_at", "processed")


@query
def op_codes(spark, sf_dir):
    log = t.read(spark, sf_dir, "orders").select(
        F.translate("o_orderstatus", "OPF", "IUX").alias("log_op")
    )
    return log.groupBy("log_op", envelope_op(F.col("log_op")).alias("op")).agg(F.count("*").alias("n"))


# -- polling ------------------------------------------------------------------------------


@query
def polled_changes(spark, sf_dir):
    return poll_changes(t.polled_orders(spark, sf_dir), POLLED_AT)


@query
def polled_overlap(spark, sf_dir):
    return poll_changes(t.polled_orders(spark, sf_dir), POLLED_AT, "30 days")


@query
def poll_ops(spark, sf_dir):
    return poll_envelope(t.stamped_orders(spark, sf_dir), t.POLL_SPEC).drop("updated_at")


@query
def poll_watermark(spark, sf_dir):
    table = t.polled_orders(spark, sf_dir)
    return next_watermark(poll_changes(table, POLLED_AT), POLLED_AT)


@query
def source_by_recency(spark, sf_dir):
    return audit.by_recency(t.polled_orders(spark, sf_dir), "updated_at", "id").select("id", "updated_at")


# -- snapshot, difference, audit ----------------------------------------------------------

CUSTOMER_SPEC = TableSpec(
    {"name": Field("name"), "value": Field("value", "double"), "created_at": Field("created_at", "timestamp")},
    key="id",
)


def _customers(spark, sf_dir) -> DataFrame:
    return t.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("value"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


SNAPSHOT_AT = "2023-12-31 00:00:00"


@query
def snapshot_envelope(spark, sf_dir):
    sent = snapshot_messages(_customers(spark, sf_dir), CUSTOMER_SPEC, t.at(SNAPSHOT_AT), "id")
    raw = sent.select(
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        "key",
        F.col("value").alias("message"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    return parse(raw, CUSTOMER_SPEC).select("id", "name", "value", "__op", "__source_ts_ms", "__deleted")


def _order_states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The state at the cut and the state after all orders."""
    rows = t.order_rows(spark, sf_dir)
    early = F.col("kafka_timestamp") < t.at(t.ORDERS_CUT)
    return tuple(
        latest_per_key(part, "id").filter(F.col("__op") != DELETE).select(*t.ORDER_SPEC.columns)
        for part in (rows.filter(early), rows)
    )


@query
def snapshot_diff(spark, sf_dir):
    before, after = _order_states(spark, sf_dir)
    rows = diff_snapshots(before, after, "id", "orders", t.at(t.ORDERS_CUT))
    image = "price double, name string, created_at string"
    rows = rows.select(
        "*", F.from_json("old_data", image).alias("_old"), F.from_json("new_data", image).alias("_new")
    )
    return rows.select(
        "table_name",
        "operation",
        "record_id",
        F.col("_old.price").alias("old_price"),
        F.col("_new.price").alias("new_price"),
        F.col("_old.name").alias("old_name"),
        F.col("_new.name").alias("new_name"),
        from_iso(F.col("_new.created_at")).alias("new_created_at"),
        "changed_at",
        "processed",
    )


@query
def reconcile_rows(spark, sf_dir):
    stale, source = _order_states(spark, sf_dir)
    return reconcile(source, stale, "id")


@query
def reconcile_digest(spark, sf_dir):
    """The same rows, by digests of key ranges; the state's are those that its store keeps."""
    stale, source = _order_states(spark, sf_dir)
    state = StateStore(spark, scratch(spark, "state"), t.ORDER_SPEC)
    state.load(stale)
    return by_digest(source, state.current(), "id", state.digests())


@query
def capture_lag(spark, sf_dir):
    """By days."""
    return audit.capture_lag(parse(decode(t.lagged_topic(spark, sf_dir)), t.EVENT_SPEC), "1 day")


@query
def reconcile_summary(spark, sf_dir):
    stale, source = _order_states(spark, sf_dir)
    return reconcile_counts(source, stale, "id")


@query
def op_mix(spark, sf_dir):
    return audit.op_mix(parse(_raw_events(spark, sf_dir), t.EVENT_SPEC))


# -- whole captures -----------------------------------------------------------------------


@query
def log_capture(spark, sf_dir):
    """Snapshot of a table, then its changes: topic, raw store, state."""
    topic = Topic(spark, scratch(spark, "topic"), "events", t.TOPIC_PARTITIONS)
    raw = RawStore(spark, scratch(spark, "raw"))
    state = StateStore(spark, scratch(spark, "state"), t.EVENT_SPEC)
    jobs.snapshot(_customers(spark, sf_dir), topic, CUSTOMER_SPEC, t.at(SNAPSHOT_AT))
    jobs.land(topic.read(), raw)
    jobs.materialize(raw, state, t.EVENT_SPEC)
    rows = with_key(t.event_rows(spark, sf_dir).withColumnRenamed("offset", "event_id"), "id", t.EVENT_SPEC)
    topic.publish(rows.drop("partition"), ["kafka_timestamp", "event_id"], t.event_messages)
    jobs.land(topic.read(), raw)
    jobs.materialize(raw, state, t.EVENT_SPEC)
    return state.current()


@query
def trigger_capture(spark, sf_dir):
    """A change log drained in two rounds, applied incrementally and then compacted."""
    topic = Topic(spark, scratch(spark, "topic"), "orders", t.TOPIC_PARTITIONS)
    sent = SentLog(spark, scratch(spark, "sent"))
    raw = RawStore(spark, scratch(spark, "raw"))
    state = StateStore(spark, scratch(spark, "state"), t.ORDER_SPEC)
    log = t.order_changelog(spark, sf_dir)
    for part in (log.filter(F.col("changed_at") < t.at(t.ORDERS_CUT)), log):
        jobs.drain(part, sent, topic, t.ORDER_SPEC)
        jobs.land(topic.read(), raw)
        jobs.materialize(raw, state, t.ORDER_SPEC, "incremental")
    state.compact()
    return state.current()


@query
def polling_capture(spark, sf_dir):
    """Two polls of a changing table; deletes would go unseen."""
    topic = Topic(spark, scratch(spark, "topic"), "orders", t.TOPIC_PARTITIONS)
    mark = Watermark(spark, scratch(spark, "watermark"))
    raw = RawStore(spark, scratch(spark, "raw"))
    state = StateStore(spark, scratch(spark, "state"), t.POLL_SPEC)
    for now in (t.ORDERS_CUT, None):
        jobs.poll(t.polled_orders(spark, sf_dir, now), mark, topic, t.POLL_SPEC)
        jobs.land(topic.read(), raw)
        jobs.materialize(raw, state, t.POLL_SPEC, "incremental")
    return state.current()


@query
def poll_deletes(spark, sf_dir):
    """Two polls; in between, rows of one priority are marked as deleted, and those of another are gone."""
    topic = Topic(spark, scratch(spark, "topic"), "orders", t.TOPIC_PARTITIONS)
    mark = Watermark(spark, scratch(spark, "watermark"))
    raw = RawStore(spark, scratch(spark, "raw"))
    state = StateStore(spark, scratch(spark, "state"), t.POLL_SPEC)
    jobs.poll(t.polled_orders(spark, sf_dir, t.ORDERS_CUT), mark, topic, t.POLL_SPEC)
    jobs.land(topic.read(), raw)
    jobs.materialize(raw, state, t.POLL_SPEC)
    left = t.thinned_orders(spark, sf_dir)
    jobs.poll(left, mark, topic, t.POLL_SPEC, deleted="deleted_at")
    jobs.poll_deletes(left, state, topic, t.POLL_SPEC, t.at(t.THINNED_AT))
    jobs.land(topic.read(), raw)
    jobs.materialize(raw, state, t.POLL_SPEC)
    return state.current()


@query
def snapshot_chunks(spark, sf_dir):
    """A table sent in four ranges of keys, in two calls, while it changes: time goes on with every look at it or at its
    log. What changed since is drained after that."""
    topic = Topic(spark, scratch(spark, "topic"), "orders", t.TOPIC_PARTITIONS)
    sent, raw = SentLog(spark, scratch(spark, "sent")), RawStore(spark, scratch(spark, "raw"))
    state = StateStore(spark, scratch(spark, "state"), t.POLL_SPEC)
    progress = scratch(spark, "progress")
    now = iter(t.LOOKS)
    for most in (2, None):
        jobs.snapshot_chunks(
            lambda: t.booked_orders(spark, sf_dir, next(now)),
            lambda: t.booked_changelog(spark, sf_dir, next(now)),
            ChunkProgress(spark, progress),
            sent,
            topic,
            t.POLL_SPEC,
            chunks=4,
            late=timedelta(0),
            most=most,
        )
        jobs.land(topic.read(), raw)
        jobs.materialize(raw, state, t.POLL_SPEC)
    jobs.drain(t.booked_changelog(spark, sf_dir), sent, topic, t.POLL_SPEC)
    jobs.land(topic.read(), raw)
    jobs.materialize(raw, state, t.POLL_SPEC)
    return state.current()


@query
def drain_captured(spark, sf_dir):
    """A log of several tables: only the captured ones reach the topic."""
    topic = Topic(spark, scratch(spark, "topic"), "orders", t.TOPIC_PARTITIONS)
    log, sent = t.order_changelog(spark, sf_dir), SentLog(spark, scratch(spark, "sent"))
    jobs.drain(log, sent, topic, t.ORDER_SPEC, tables=["orders_1", "orders_2"])
    return decode(topic.read()).groupBy("key").agg(F.count("*").alias("n"))


@query
def drain_late_commit(spark, sf_dir):
    """Changes that commit after later ones were sent are sent by the next round, however old."""
    topic = Topic(spark, scratch(spark, "topic"), "orders", t.TOPIC_PARTITIONS)
    sent = SentLog(spark, scratch(spark, "sent"))
    log = t.order_changelog(spark, sf_dir)
    jobs.drain(log.filter(F.col("changed_at") >= t.at(t.ORDERS_CUT)), sent, topic, t.ORDER_SPEC)
    late = jobs.drain(log, sent, topic, t.ORDER_SPEC)
    return late.select("change_id", "changed_at")


@query
def drain_closed_days(spark, sf_dir):
    """What a round sends after the days before the cut were closed, and what it does not read any more: the changes
    of one table that were committed after that."""
    topic = Topic(spark, scratch(spark, "topic"), "orders", t.TOPIC_PARTITIONS)
    sent = SentLog(spark, scratch(spark, "sent"))
    log = t.order_changelog(spark, sf_dir)
    early = log.filter((F.col("changed_at") < t.at(t.ORDERS_CUT)) & (F.col("table_name") != "orders_5"))
    jobs.drain(early, sent, topic, t.ORDER_SPEC)
    jobs.close_days(early, sent, datetime.fromisoformat(t.ORDERS_CUT).date())
    found = jobs.drain(log, sent, topic, t.ORDER_SPEC).select("change_id", F.lit("sent").alias("fate"))
    return found.unionByName(missed(log, sent).select("change_id", F.lit("missed").alias("fate")))


@query
def poll_from_initial(spark, sf_dir):
    """The first poll with a mark that names no zone, which is UTC."""
    return poll_changes(t.polled_orders(spark, sf_dir), datetime.fromisoformat(t.ORDERS_CUT))


@query
def poll_iso(spark, sf_dir):
    """Polled rows as messages of the ISO encoding and back."""
    spec = replace(t.POLL_SPEC, time_format=ISO)
    rows = with_key(t.stamped_orders(spark, sf_dir), "id", spec)
    raw = poll_messages(rows, spec, "updated_at").select(
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        "key",
        F.col("value").alias("message"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    return parse(raw, spec).select("id", "created_at")


@query
def changelog_micros(spark, sf_dir):
    """The change log as messages of the microsecond encoding and back."""
    spec = replace(t.ORDER_SPEC, time_format=MICROS)
    sent = changelog_messages(t.order_changelog(spark, sf_dir), spec)
    raw = sent.select(
        F.lit(0).alias("partition"),
        F.col("change_id").alias("offset"),
        "key",
        F.col("value").alias("message"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    return parse(raw, spec).filter("reject IS NULL").select("offset", "id", "created_at")


@query
def state_by_offset(spark, sf_dir):
    """The state by place in the topic alone, where record times run against the offsets."""
    backwards = t.at(t.EVENTS_CUT) - F.make_dt_interval(secs=F.col("offset").cast("decimal(18,6)"))
    raw = RawStore(spark, scratch(spark, "raw"))
    state = StateStore(spark, scratch(spark, "state"), t.EVENT_SPEC)
    jobs.land(t.events_topic(spark, sf_dir).withColumn("timestamp", backwards), raw)
    jobs.materialize(raw, state, t.EVENT_SPEC, "replay", ("partition", "offset"))
    return state.current()


# -- streams ------------------------------------------------------------------------------


@query
def stream_land(spark, sf_dir):
    topic = t.written_topic(spark, sf_dir)
    raw = RawStore(spark, scratch(spark, "raw"))
    streams.stream_land(streams.read_topic_stream(topic), raw, scratch(spark, "land")).awaitTermination()
    return raw.read().select("partition", "offset", "key", "kafka_timestamp")


@query
def stream_land_repeated(spark, sf_dir):
    """A source that delivers records again, in the same and in later micro-batches."""
    topic = Topic(spark, scratch(spark, "topic"), "events", t.TOPIC_PARTITIONS)
    records = t.events_topic(spark, sf_dir)
    early = records.filter(F.col("timestamp") < t.at(t.EVENTS_CUT))
    topic.append(early.unionAll(early.filter("offset % 3 = 0")))
    topic.append(records)
    raw = RawStore(spark, scratch(spark, "raw"))
    stream = streams.read_topic_stream(topic, files_per_batch=1)
    streams.stream_land(stream, raw, scratch(spark, "land"), repeats_within="1 hour").awaitTermination()
    return raw.read().select("partition", "offset", "key", "kafka_timestamp")


@query
def stream_upsert(spark, sf_dir):
    """Two micro-batches applied to the state."""
    topic = Topic(spark, scratch(spark, "topic"), "events", t.TOPIC_PARTITIONS)
    state = StateStore(spark, scratch(spark, "state"), t.EVENT_SPEC)
    checkpoint = scratch(spark, "apply")
    records = t.events_topic(spark, sf_dir)
    early = F.col("timestamp") < t.at(t.EVENTS_CUT)
    for part in (records.filter(early), records.filter(~early)):
        topic.append(part)
        stream = streams.read_topic_stream(topic)
        streams.stream_apply(stream, state, t.EVENT_SPEC, checkpoint).awaitTermination()
    return state.current()


@query
def stream_drain(spark, sf_dir):
    """A change log streamed to a topic."""
    log_path = scratch(spark, "changelog")
    log = t.order_changelog(spark, sf_dir)
    log.write.parquet(log_path)
    topic = Topic(spark, scratch(spark, "topic"), "orders", t.TOPIC_PARTITIONS)
    stream = spark.readStream.schema(log.schema).parquet(log_path)
    streams.stream_drain(
        stream, topic, t.ORDER_SPEC, scratch(spark, "drain"), streams.CAUGHT_UP
    ).awaitTermination()
    sent = parse(decode(topic.read()), t.ORDER_SPEC)
    return sent.select(*t.ORDER_SPEC.columns, "__op", "__source_ts_ms", "__deleted")
