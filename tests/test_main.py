"""The jobs from the command line, over files."""

from rowtide.__main__ import main
from rowtide.sources.changelog import SentLog
from rowtide.sources.rejects import Rejects
from rowtide.sources.state import StateStore
from rowtide.sources.topic import Topic
from rowtide.spec import USERS, USERS_ISO
from tests.helpers import rows, utc

AT = utc("2025-01-01")


def test_log_jobs(spark, tmp_path):
    users = str(tmp_path / "users")
    spark.createDataFrame([(1, "a", "e", 3, AT)], USERS.state_schema).write.parquet(users)
    topic = ["--topic", "users", "--topic-path", str(tmp_path / "t")]
    main(["snapshot", "--table", users, *topic])
    main(["land", *topic, "--raw", str(tmp_path / "raw")])
    for mode in ("incremental", "replay"):
        stores = ["--raw", str(tmp_path / "raw"), "--state", str(tmp_path / "s"), "--rejects", str(tmp_path / "r")]
        main(["materialize", *stores, "--mode", mode])
    main(["reconcile", "--table", users, "--state", str(tmp_path / "s"), "--out", str(tmp_path / "differ")])
    assert spark.read.parquet(str(tmp_path / "differ")).isEmpty()
    assert rows(Rejects(spark, str(tmp_path / "r")).counts().filter("n > 0")) == [("accepted", 1)]
    state = StateStore(spark, str(tmp_path / "s"), USERS)
    assert rows(state.current()) == [(1, "a", "e", 3, AT.replace(tzinfo=None))]


def test_poll_and_drain_jobs(spark, tmp_path):
    users, log = str(tmp_path / "users"), str(tmp_path / "log")
    schema = USERS.state_schema + ", updated_at timestamp"
    spark.createDataFrame([(1, "a", "e", 3, AT, AT)], schema).write.parquet(users)
    spark.sql(
        "select 7L change_id, 'users' table_name, 'D' operation, 2L record_id, '{}' old_data, "
        "cast(null as string) new_data, timestamp'2025-01-01' changed_at, false processed"
    ).write.parquet(log)
    topic = ["--topic", "users", "--topic-path", str(tmp_path / "t")]
    for _ in range(2):
        main(["--capture", "polling", "poll", "--table", users, *topic, "--watermark", str(tmp_path / "w")])
        main(["--capture", "trigger", "drain", "--table", log, *topic, "--sent", str(tmp_path / "sent")])
    main(["--capture", "trigger", "close", "--table", log, "--sent", str(tmp_path / "sent"), "--before", "2025-01-02"])
    assert SentLog(spark, str(tmp_path / "sent")).closed() == 20090
    sent = Topic(spark, str(tmp_path / "t"), "users").read().selectExpr("cast(key as string)", "offset")
    assert rows(sent) == [('{"id":1}', 0), ('{"id":2}', 1)]
    assert USERS_ISO.ops == ("c", "u", "d")
