import pytest
from pyspark.sql import functions as F

from rowtide.functions.messages import json_object
from rowtide.functions.ops import envelope_op, infer_op
from rowtide.functions.times import from_iso, from_micros, to_iso
from rowtide.operators.parse import accepted, decode, key_id, parse, quarantined, unwrap
from rowtide.spec import USERS, USERS_ISO
from tests.helpers import key, message, micros, raw_df, record, rows, topic_df, utc


def test_decode_names_and_text(spark):
    topic = topic_df(spark, record(2, 7, key(1), message(1, "c")))
    out = decode(topic)
    assert out.columns == ["partition", "offset", "key", "message", "kafka_timestamp"]
    assert rows(out, "partition", "offset", "key") == [(2, 7, key(1))]


def test_faults_are_quarantined_and_the_rest_survives(spark):
    raw = raw_df(
        spark,
        record(0, 0, None, "{}"),
        record(0, 1, None, "oops"),
        record(0, 2, None, '{"id":"abc","__op":"c"}'),
        record(0, 3, key(3), message(3, "t")),
        record(0, 4, key(4), message(4, None)),
        record(0, 5, key(5), "oops"),
        record(0, 6, key(6), message(6, "c", name="ok")),
        record(0, 7, key(7), None),
        record(0, 8, '{"ID":8}', '{"ID":8,"__op":"c"}'),
    )
    parsed = parse(raw, USERS)
    assert rows(quarantined(parsed), "offset", "reject") == [
        (0, "no_key"), (1, "no_key"), (2, "no_key"), (3, "unknown_op"), (4, "unknown_op"),
        (5, "unknown_op"), (8, "no_key"),
    ]
    assert rows(accepted(parsed, USERS), "ID", "name") == [(6, "ok")]


def test_key_comes_first_then_body(spark):
    raw = raw_df(
        spark,
        record(0, 0, key(1), message(99, "c")),
        record(0, 1, None, message(2, "c")),
        record(0, 2, '{"id":null}', message(3, "c")),
        record(0, 3, '{"id":"4"}', message(99, "c")),
        record(0, 4, '{"x":{"id":7},"id": 5}', message(99, "c")),
        record(0, 5, "6", message(6, "c")),
    )
    assert rows(accepted(parse(raw, USERS), USERS), "offset", "ID") == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 6)]


@pytest.mark.parametrize(
    "text", ['{"id":7}', '{"id": 7}', '{"id":-7}', '{"id":07}', '{"id":+7}', '{"id":7.0}', '{"id":7} ',
             '{"id":99999999999999999999}', '{"id":"7"}', '{"id":true}', '{"i":7}', '{"id":7', "7", "", None]
)
def test_key_pattern_agrees_with_json(spark, text):
    df = spark.createDataFrame([(text,)], "key string")
    fast, slow = df.select(
        key_id(F.col("key"), "id"), F.get_json_object("key", "$.id").try_cast("long")
    ).first()
    assert fast == slow


def test_missing_and_bad_fields_are_null(spark):
    raw = raw_df(
        spark,
        record(0, 0, key(1), message(1, "u", name=None, age="x", created_at="soon")),
        record(0, 1, key(2), message(2, "u", age=30.5)),
        record(0, 2, key(3), message(3, "u", name=5, age="31", created_at=micros("1969-12-31 23:59:59.500000"))),
    )
    got = {r["ID"]: r for r in accepted(parse(raw, USERS), USERS).collect()}
    assert (got[1]["name"], got[1]["age"], got[1]["created_at"]) == (None, None, None)
    assert got[2]["age"] is None
    assert (got[3]["name"], got[3]["age"]) == ("5", 31)
    assert got[3]["created_at"] == utc("1969-12-31 23:59:59.500000").replace(tzinfo=None)


def test_optional_fields_are_read(spark):
    raw = raw_df(spark, record(0, 0, key(1), message(1, "d", __source_ts_ms=123, __deleted="true")))
    assert rows(parse(raw, USERS), "__source_ts_ms", "__deleted") == [(123, "true")]


def test_tombstone_policy(spark):
    raw = raw_df(spark, record(0, 0, key(1), None))
    assert rows(parse(raw, USERS), "__op", "reject") == [(None, "tombstone")]
    assert rows(parse(raw, USERS, tombstones="delete"), "__op", "reject") == [("d", None)]
    assert quarantined(parse(raw, USERS)).isEmpty()
    with pytest.raises(ValueError):
        parse(raw, USERS, tombstones="keep")


def test_accepted_operations_follow_the_spec(spark):
    raw = raw_df(spark, record(0, 0, key(1), message(1, "r")))
    assert rows(parse(raw, USERS), "reject") == [(None,)]
    assert rows(parse(raw, USERS_ISO), "reject") == [("unknown_op",)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2025-11-24T14:32:35.015026", "2025-11-24 14:32:35.015026"),
        ("2025-11-24T14:32:35.0150", "2025-11-24 14:32:35.015000"),
        ("2025-11-24T14:32:35", "2025-11-24 14:32:35"),
        ("2025-11-24T14:32:35+02:00", "2025-11-24 12:32:35"),
        ("2025-11-24T14:32:35.015026Z", "2025-11-24 14:32:35.015026"),
        ("", None),
        ("soon", None),
        (None, None),
    ],
)
def test_iso_shapes(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(from_iso(F.col("t")).alias("t"))
    got = df.first()[0]
    assert got == (want and utc(want).replace(tzinfo=None))


def test_times_round_trip(spark):
    df = spark.createDataFrame([(utc("2025-11-24 14:32:35.015026"),), (utc("2025-11-24 14:32:35"),)], "t timestamp")
    texts = rows(df.select(to_iso(F.col("t")).alias("x")))
    assert texts == [("2025-11-24T14:32:35",), ("2025-11-24T14:32:35.015026",)]
    back = df.select((from_iso(to_iso(F.col("t"))) == F.col("t")) & (from_micros(F.unix_micros("t")) == F.col("t")))
    assert rows(back) == [(True,), (True,)]


def test_second_precision_drops_the_fraction(spark):
    raw = raw_df(spark, record(0, 0, key(1), message(1, "c", created_at=micros("2025-01-01 10:00:00.999999"))))
    got = parse(raw, USERS, precision="second").first()["created_at"]
    assert got == utc("2025-01-01 10:00:00").replace(tzinfo=None)


def test_op_codes(spark):
    df = spark.createDataFrame([(c,) for c in ("I", "U", "D", "T", None)], "c string")
    assert [r[0] for r in df.select(envelope_op(F.col("c"))).collect()] == ["c", "u", "d", "T", None]


@pytest.mark.parametrize(
    ("created", "updated", "want"),
    [
        ("2025-01-01 00:00:00", "2025-01-01 00:00:00.999999", "c"),
        ("2025-01-01 00:00:00.999999", "2025-01-01 00:00:00", "c"),
        ("2025-01-01 00:00:00", "2025-01-01 00:00:01", "u"),
        (None, "2025-01-01 00:00:00", "u"),
        ("2025-01-01 00:00:00", None, "u"),
    ],
)
def test_inferred_op(spark, created, updated, want):
    row = (created and utc(created), updated and utc(updated))
    df = spark.createDataFrame([row], "c timestamp, u timestamp")
    assert df.select(infer_op(F.col("c"), F.col("u"))).first()[0] == want


def test_messages_keep_nulls(spark):
    df = spark.range(1).select(json_object({"id": F.col("id"), "name": F.lit(None).cast("string")}).alias("m"))
    assert df.first()[0] == '{"id":0,"name":null}'


def test_unwrap_policies(spark):
    envelope = '{"before":%s,"after":%s,"source":{"ts_ms":5},"op":"%s"}'
    old = '{"id":1,"name":"a \\"q\\"","age":3,"created_at":7}'
    raw = raw_df(
        spark,
        record(0, 0, None, envelope % ("null", old, "c")),
        record(0, 1, key(1), envelope % (old, "null", "d")),
        record(0, 2, key(1), None),
    )
    flat = unwrap(raw, USERS)
    parsed = parse(flat, USERS)
    assert rows(parsed, "offset", "ID", "name", "age", "__op", "__source_ts_ms", "__deleted") == [
        (0, 1, 'a "q"', 3, "c", 5, "false"),
        (1, 1, 'a "q"', 3, "d", 5, "true"),
    ]
    assert '"age":3' in flat.first()["message"]
    assert unwrap(raw, USERS, drop_tombstones=False).count() == 3
    assert unwrap(raw, USERS, handle_deletes=False).count() == 1
