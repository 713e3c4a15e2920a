"""Run one job: ``spark-submit ... rowtide/__main__.py <job> <options>`` or ``python -m rowtide``.

The captured table is the users table; other tables use the functions in ``rowtide.plans``.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from rowtide import session
from rowtide.operators.compare import reconcile_digest
from rowtide.plans import jobs
from rowtide.sources.changelog import SentLog
from rowtide.sources.jdbc import read_table
from rowtide.sources.polled import Watermark
from rowtide.sources.raw import SCHEMA_VERSION, RawStore
from rowtide.sources.rejects import Rejects
from rowtide.sources.state import StateStore
from rowtide.sources.topic import KafkaTopic, Topic
from rowtide.spec import PLACE, USERS, USERS_ISO

SPECS = {"log": USERS, "polling": USERS, "trigger": USERS_ISO}
ORDERS = {"time": PLACE, "offset": ("partition", "offset")}


def _arguments(args: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rowtide")
    parser.add_argument("--master", help="Spark master; left to spark-submit by default")
    parser.add_argument("--capture", choices=sorted(SPECS), default="log", help="how changes are captured")
    job = parser.add_subparsers(dest="job", required=True)

    def topic(p):
        p.add_argument("--topic", required=True, help="topic name")
        p.add_argument("--servers", help="Kafka bootstrap servers")
        p.add_argument("--topic-path", help="folder of a stand-in topic, instead of Kafka")
        p.add_argument("--partitions", type=int, help="number of topic partitions")

    def source(p):
        p.add_argument("--url", help="JDBC URL of the database")
        p.add_argument("--user")
        p.add_argument("--password")
        p.add_argument("--driver")
        p.add_argument("--table", required=True, help="table name, or a Parquet folder without --url")
        p.add_argument("--split", help="parallel database reads: column,lowest,highest,reads")

    land = job.add_parser("land", help="topic to raw store")
    topic(land)
    land.add_argument("--raw", required=True)
    land.add_argument("--schema-version", type=int, default=SCHEMA_VERSION)
    land.add_argument("--files", type=int, help="most files of a landing; one for each input partition by default")

    materialize = job.add_parser("materialize", help="raw store to state table")
    materialize.add_argument("--raw", required=True)
    materialize.add_argument("--schema-version", type=int, default=SCHEMA_VERSION)
    materialize.add_argument("--state", required=True)
    materialize.add_argument("--mode", choices=["replay", "incremental"], default="incremental")
    materialize.add_argument("--buckets", type=int, help="bucket the state table by key")
    materialize.add_argument("--order", choices=sorted(ORDERS), default="time", help="what decides the latest change; offset needs --mode replay")
    materialize.add_argument("--tombstones", choices=["ignore", "delete"], default="ignore")

    materialize.add_argument("--rejects", help="folder for records that cannot be applied, and the counts")

    snapshot = job.add_parser("snapshot", help="whole table to topic")
    source(snapshot)
    topic(snapshot)

    drain = job.add_parser("drain", help="change log to topic")
    source(drain)
    topic(drain)
    drain.add_argument("--sent", required=True, help="folder of the ids already sent")
    drain.add_argument("--limit", type=int)
    drain.add_argument("--captured", nargs="+", help="tables of the log to send; all by default")

    close = job.add_parser("close", help="set finished days of the change log aside")
    source(close)
    close.add_argument("--sent", required=True, help="folder of what was sent")
    close.add_argument("--before", type=date.fromisoformat, required=True, help="the first day that stays open")
    close.add_argument("--captured", nargs="+", help="tables of the log; all by default")

    reconcile = job.add_parser("reconcile", help="rows on which a state table differs from its source, to Parquet")
    source(reconcile)
    reconcile.add_argument("--state", required=True)
    reconcile.add_argument("--buckets", type=int)
    reconcile.add_argument("--out", required=True)

    poll = job.add_parser("poll", help="updated rows to topic")
    source(poll)
    topic(poll)
    poll.add_argument("--watermark", required=True, help="folder of the saved watermark")
    poll.add_argument("--initial-watermark", type=datetime.fromisoformat)
    poll.add_argument("--overlap", help='interval to read again, such as "5 minutes"')

    compact = job.add_parser("compact", help="fold applied changes into a full version of the state")
    compact.add_argument("--state", required=True)
    compact.add_argument("--buckets", type=int)
    compact.add_argument("--keep", type=int, help="also delete what the newest so many versions do not need")
    return parser.parse_args(args)


def main(args: list[str] | None = None) -> None:
    a = _arguments(args)
    spark = session.build(f"rowtide-{a.job}", a.master)
    session.utc(spark)
    spec = SPECS[a.capture]

    def topic():
        if a.topic_path:
            return Topic(spark, a.topic_path, a.topic, a.partitions or 1)
        return KafkaTopic(spark, a.servers, a.topic)

    def table():
        if a.url:
            split = None
            if a.split:
                column, *numbers = a.split.split(",")
                split = (column, *map(int, numbers))
            return read_table(
                spark, a.url, a.table, user=a.user, password=a.password, driver=a.driver, split=split
            )
        return spark.read.parquet(a.table)

    if a.job == "land":
        raw = RawStore(spark, a.raw, a.schema_version)
        if a.topic_path:
            jobs.land(topic().read(), raw, a.files)
        else:
            jobs.land_kafka(raw, a.servers, a.topic, a.partitions, a.files)
    elif a.job == "materialize":
        raw = RawStore(spark, a.raw, a.schema_version)
        state = StateStore(spark, a.state, spec, a.buckets)
        rejects = Rejects(spark, a.rejects) if a.rejects else None
        jobs.materialize(raw, state, spec, a.mode, ORDERS[a.order], rejects, tombstones=a.tombstones)
    elif a.job == "snapshot":
        jobs.snapshot(table(), topic(), spec)
    elif a.job == "drain":
        jobs.drain(table(), SentLog(spark, a.sent), topic(), spec, a.limit, a.captured)
    elif a.job == "close":
        jobs.close_days(table(), SentLog(spark, a.sent), a.before, a.captured)
    elif a.job == "reconcile":
        state = StateStore(spark, a.state, spec, a.buckets)
        found = reconcile_digest(table().select(*spec.columns), state.current(), spec.key, state.digests())
        found.write.parquet(a.out)
    elif a.job == "poll":
        mark = Watermark(spark, a.watermark)
        jobs.poll(table(), mark, topic(), spec, a.overlap, initial_watermark=a.initial_watermark)
    elif a.job == "compact":
        state = StateStore(spark, a.state, spec, a.buckets)
        state.compact()
        if a.keep:
            state.purge(a.keep)
    session.discard_scratch(spark)


if __name__ == "__main__":
    main()
