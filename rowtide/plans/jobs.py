"""The batch jobs. Each writes its data first and its progress after, so a job that dies in
between repeats work but loses none."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from datetime import UTC, date, datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.capture import (
    changelog_messages,
    gone_messages,
    needed_image,
    poll_messages,
    snapshot_messages,
    with_key,
)
from rowtide.operators.latest import latest_per_key
from rowtide.operators.offsets import all_partitions, from_points, starting_offsets_json
from rowtide.operators.parse import accepted, changes, decode, parse, quarantined, with_order
from rowtide.session import delete_path, pinned, scratch
from rowtide.sources.batches import evened
from rowtide.sources.changelog import OLDEST_FIRST, SentLog, captured, day, in_open_days, pending, since
from rowtide.sources.chunks import ChunkProgress, in_range, key_ranges
from rowtide.sources.polled import Watermark, in_utc, next_watermark, poll_changes
from rowtide.sources.raw import RawStore
from rowtide.sources.rejects import Rejects, Tally
from rowtide.sources.state import StateStore
from rowtide.sources.topic import KafkaTopic, Topic, read_kafka
from rowtide.spec import PLACE, TableSpec


def land(records: DataFrame, raw: RawStore, files: int | None = None, even: bool = False) -> int | None:
    """Topic records to the raw store, from where the last landing ended. Nothing is shuffled, and the
    topic is read once. A landing has a file for each input partition, or at most ``files``. With ``even`` records
    are shuffled to files of about the advised partition size, whatever the topic's partitions hold."""
    start = pinned(raw.next_offsets())
    return raw.append_some(_sized(decode(from_points(records, start)), files, even), start)


def _sized(rows: DataFrame, files: int | None, even: bool = False) -> DataFrame:
    if even:
        return evened(rows)
    return rows if files is None else rows.coalesce(files)


def kafka_start(raw: RawStore, topic: str, partitions: int | None) -> str:
    """Where to read a Kafka topic from: its beginning on the first run, after that the places
    landed up to. The start option then has to name all ``partitions`` of the topic."""
    landed = raw.next_offsets()
    if landed.isEmpty():
        return "earliest"
    if partitions is None:
        raise ValueError("give the topic's number of partitions: a start has to name them all")
    return starting_offsets_json(all_partitions(landed, partitions), topic).first()["starting_offsets"]


def land_kafka(
    raw: RawStore,
    servers: str,
    topic: str,
    partitions: int | None = None,
    files: int | None = None,
    even: bool = False,
) -> int | None:
    """The same from a Kafka topic; needs Spark's Kafka connector."""
    start = kafka_start(raw, topic, partitions)
    return raw.append_some(_sized(decode(read_kafka(raw.spark, servers, topic, start)), files, even))


def newest_changes(
    raw: DataFrame, spec: TableSpec, order: tuple[str, ...] = PLACE, **options: str
) -> DataFrame:
    """The latest usable change of each key in ``order``, with its place."""
    return with_order(latest_per_key(changes(raw, spec, **options), spec.key, order))


def newest_and_rejected(
    raw: DataFrame, spec: TableSpec, order: tuple[str, ...] = PLACE, **options: str
) -> tuple[DataFrame, DataFrame, Tally]:
    """The same, what is rejected, and the counts of both, which are there once the first has been computed."""
    tally, parsed = Tally(), parse(raw, spec, **options)
    usable = accepted(tally.over(parsed), spec)
    return with_order(latest_per_key(usable, spec.key, order)), quarantined(parsed), tally


def materialize(
    raw: RawStore,
    state: StateStore,
    spec: TableSpec,
    mode: str = "incremental",
    order: tuple[str, ...] = PLACE,
    rejects: Rejects | None = None,
    **options: str,
) -> int | None:
    """Raw store to state table.

    ``replay`` ranks the whole history and rewrites the state. ``incremental`` reads only
    records beyond those applied and writes only the keys they touch. Both give the same state.
    ``order`` ranks the changes of a key; an order other than by record time needs ``replay``, as
    stored rows are compared by their whole place.

    With ``rejects`` the records that cannot be applied are kept there with their reasons, and how many records of
    each kind were read. They are counted in the pass that makes the state; only a run that has rejects reads its
    records again, to write them. They are in place before the version of the state is.
    """
    if order != PLACE and mode != "replay":
        raise ValueError("an order of its own needs mode replay")
    if mode not in ("replay", "incremental"):
        raise ValueError(f"mode must be replay or incremental, not {mode}")
    if mode == "replay":
        if not raw.records.numbers():
            return None
        records, points = raw.read(), pinned(raw.next_offsets())
        apply = partial(state.rebuild, points=points, afresh=order != PLACE)
    else:
        applied = pinned(state.applied_offsets())
        records, reached = raw.read_since(applied)
        points = pinned(reached)
        if sorted(points.collect()) == sorted(applied.collect()):  # a row for each topic partition
            return None
        apply = partial(state.apply, points=points)
    if rejects is None:
        return apply(newest_changes(records, spec, order, **options))
    newest, rejected, tally = newest_and_rejected(records, spec, order, **options)
    number = apply(newest, beside=lambda number: rejects.save(rejected, tally.counts(), number))
    if mode == "replay":
        rejects.forget(number)
    return number


def snapshot(table: DataFrame, topic: Topic | KafkaTopic, spec: TableSpec, at: Column | None = None) -> DataFrame:
    """Send every row of a table as operation ``r``."""
    rows = with_key(table.select(*spec.columns), spec.key, spec)
    return topic.publish(rows, [spec.key], lambda placed, *keep: snapshot_messages(placed, spec, at, *keep), False)


def publish_changes(changelog: DataFrame, topic: Topic | KafkaTopic, spec: TableSpec) -> DataFrame:
    """Change-log rows to a topic, oldest first."""
    rows = with_key(needed_image(changelog), "record_id", spec)
    return topic.publish(rows, OLDEST_FIRST, lambda placed, *keep: changelog_messages(placed, spec, *keep))


def drain(
    changelog: DataFrame,
    sent: SentLog,
    topic: Topic | KafkaTopic,
    spec: TableSpec,
    limit: int | None = None,
    tables: Iterable[str] | None = None,
) -> DataFrame:
    """Send waiting changes, oldest first, then mark exactly those as sent. ``tables`` are the
    captured ones; a log of several needs it, as a topic and a spec are of one table. Only days
    that have waiting changes are compared change by change, and closed days are not read."""
    log = _open_log(changelog, sent, tables)
    published = publish_changes(pending(*in_open_days(log, sent.read()), limit), topic, spec)
    if not published.isEmpty():
        sent.mark(published)
    return published


def drain_loop(
    changelog: Callable[[], DataFrame],
    sent: SentLog,
    topic: Topic | KafkaTopic,
    spec: TableSpec,
    limit: int = 100,
    tables: Iterable[str] | None = None,
    busy: float = 0.5,
    idle: float = 2.0,
    go_on: Callable[[], bool] = lambda: True,
    pause: Callable[[float], None] = time.sleep,
) -> None:
    """Drain in rounds of at most ``limit`` changes for as long as ``go_on`` says. After a round that sent something the
    next follows in ``busy`` seconds, after one that found nothing in ``idle`` seconds. ``changelog`` is called in each
    round, as a table of files is listed when it is opened. A round that fails ends the loop; what it had not marked as sent
    is sent by the next loop."""
    while go_on():
        found = drain(changelog(), sent, topic, spec, limit, tables)
        pause(idle if found.isEmpty() else busy)


def snapshot_chunks(
    table: Callable[[], DataFrame],
    changelog: Callable[[], DataFrame],
    progress: ChunkProgress,
    sent: SentLog,
    topic: Topic | KafkaTopic,
    spec: TableSpec,
    chunks: int = 16,
    late: timedelta = timedelta(minutes=5),
    most: int | None = None,
    tables: Iterable[str] | None = None,
) -> int:
    """Send a table in ranges of keys while it changes and its changes are sent. Returns how many ranges are left.

    For each range: what waits in the change log is sent (the low mark), the range is read and written, and then the log is
    asked again (the high mark). Rows with a change that was not sent by the low mark may be older or newer than it, so
    they are left out: the change wins, and the next drain sends it with its own row image. The other rows hold no change
    beyond those sent, and are sent as of the newest change at the low mark, less ``late``: the longest time by which a
    change may commit after its ``changed_at``. So a change that commits later wins over them, however late its drain.

    The marks are sets of changes, not times, so a change that commits late between them is seen. Progress is saved after
    each range. A snapshot that was broken off goes on with the ranges that are left; a range that is sent again
    has new marks. ``most`` bounds the ranges of one call. Run no other drain of the same log meanwhile. ``table`` and
    ``changelog`` open them anew, as they are at that time. Rows without a key are not sent.
    """
    waiting = progress.waiting(lambda: key_ranges(table(), spec.key, chunks))
    now = waiting if most is None else waiting[:most]
    for chunk in now:
        low = _open_log(changelog(), sent, tables)
        drain(low, sent, topic, spec)
        as_of = _newest(low, sent) - late
        read = in_range(table(), spec.key, chunk).select(*spec.columns)
        path = scratch(topic.spark, "chunk")
        read.write.parquet(path)
        rows = topic.spark.read.schema(read.schema).parquet(path)
        high = pending(*in_open_days(_open_log(changelog(), sent, tables), sent.read()))
        changed = high.select(F.col("record_id").alias(spec.key)).distinct()
        snapshot(rows.join(changed, spec.key, "left_anti"), topic, spec, F.lit(as_of))
        progress.finish(chunk, as_of)
        delete_path(topic.spark, path)
    return len(waiting) - len(now)


def _open_log(changelog: DataFrame, sent: SentLog, tables: Iterable[str] | None) -> DataFrame:
    return since(changelog if tables is None else captured(changelog, tables), sent.closed())


def _newest(log: DataFrame, sent: SentLog) -> datetime:
    """The newest time in the open days of a log; without one the end of the closed days, or 1970."""
    micros = log.agg(F.max(F.unix_micros(F.col("changed_at").cast("timestamp"))).alias("newest")).first()["newest"]
    start = datetime(1970, 1, 1, tzinfo=UTC)
    return start + (timedelta(days=sent.closed() or 0) if micros is None else timedelta(microseconds=micros))


def close_days(changelog: DataFrame, sent: SentLog, before: date, tables: Iterable[str] | None = None) -> None:
    """Close the days before ``before``: no change of theirs will be looked for again. They must be drained; and no
    change may commit that late any more. ``missed`` finds those that do."""
    log = _open_log(changelog, sent, tables)
    number = (before - date(1970, 1, 1)).days
    due = log.filter(day(F.col("changed_at")) < number)
    if not pending(*in_open_days(due, sent.read())).filter("changed_at IS NOT NULL").isEmpty():
        raise ValueError(f"changes before {before} are waiting: drain them first")
    sent.close(number)


def poll(
    table: DataFrame,
    watermark: Watermark,
    topic: Topic | KafkaTopic,
    spec: TableSpec,
    overlap: str | None = None,
    updated: str = "updated_at",
    initial_watermark: datetime | None = None,
    deleted: str | None = None,
) -> DataFrame:
    """Send the rows updated since the last poll, then save the new watermark. The first poll
    reads the whole table, or what was updated after ``initial_watermark``. Rows marked in the column ``deleted``, if
    the table has one, are sent as deletes; marking a row has to stamp its update."""
    last = watermark.get() or initial_watermark
    last = None if last is None else in_utc(last)
    rows = with_key(poll_changes(table, last, overlap, updated), spec.key, spec)
    published = topic.publish(
        rows,
        [updated, spec.key],
        lambda placed, *keep: poll_messages(placed, spec, updated, *keep, deleted=deleted),
        False,
    )
    newest = pinned(next_watermark(published, last, updated))  # one row
    if not published.isEmpty() and not newest.filter("last_polled IS NOT NULL").isEmpty():
        watermark.save(newest)
    return published


def poll_deletes(
    table: DataFrame, state: StateStore, topic: Topic | KafkaTopic, spec: TableSpec, at: Column | None = None
) -> DataFrame:
    """Send a delete for every key of the state that the polled table no longer has; a poll cannot see these.

    Only keys are read, of the table as of the state, and a bucketed state is not shuffled. ``at`` is the time the keys
    were read (now, by default): a row that comes back later has a later stamp and wins. Sending a delete again
    before the last one has been applied changes nothing.
    """
    gone = state.current().select(spec.key).join(table.select(spec.key), spec.key, "left_anti")
    at = F.current_timestamp() if at is None else at
    rows = with_key(gone, spec.key, spec)
    return topic.publish(rows, [spec.key], lambda placed, *keep: gone_messages(placed, spec, at, *keep), False)
