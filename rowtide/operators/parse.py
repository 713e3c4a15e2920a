"""Topic records to typed change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.messages import json_object, message_key
from rowtide.functions.ops import deleted_flag
from rowtide.functions.times import decode_time
from rowtide.spec import DELETE, ISO, ORDER, PLACE, TableSpec, op_in

META = ("__source_ts_ms", "__deleted")


def decode(topic: DataFrame) -> DataFrame:
    """Kafka's record columns to the raw-store columns: UTF-8 text key and message."""
    return topic.select(
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("message"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def key_id(key: Column, path: str) -> Column:
    """The row key in a message key. A key that is just ``{"id":n}`` is read by pattern, which
    takes a quarter of the time of JSON parsing; any other goes to the JSON parser."""
    plain = rf'^\{{"\Q{path}\E": ?(-?(?:0|[1-9][0-9]*))\}}$'
    return F.coalesce(
        F.regexp_extract(key, plain, 1).try_cast("long"),
        F.get_json_object(key, f"$.{path}").try_cast("long"),
    )


def _typed(text: Column, type_name: str, spec: TableSpec, precision: str) -> Column:
    if type_name == "string":
        return text
    if type_name == "timestamp":
        return decode_time(text, spec.time_format, precision)
    return text.try_cast(type_name)


def parse(
    raw: DataFrame, spec: TableSpec, precision: str = "microsecond", tombstones: str = "ignore"
) -> DataFrame:
    """Raw records to typed rows, one per record, with a ``reject`` reason (NULL if usable).

    ``json_tuple`` reads each message once for all fields, and since it is a generator no
    filter on its output is pushed below it and makes it run twice. A bad value becomes NULL,
    a bad message has all fields NULL; neither fails the job.

    A record without a value (a tombstone) is rejected by ``tombstones="ignore"``, so that it
    cannot hide the delete before it, and read as a delete by ``tombstones="delete"``.
    """
    if tombstones not in ("ignore", "delete"):
        raise ValueError(f"tombstones must be ignore or delete, not {tombstones}")
    paths = [spec.key_path, *[f.path for f in spec.fields.values()], "__op", *META]
    texts = [f"_text_{i}" for i in range(len(paths))]
    read = raw.withColumn("_key_id", key_id(F.col("key"), spec.key_path)).select(
        "*", F.json_tuple("message", *paths).alias(*texts)
    )
    op = F.col(texts[-3])
    if tombstones == "delete":
        op = F.when(F.col("message").isNull(), DELETE).otherwise(op)
    values = [
        _typed(F.col(text), f.type, spec, precision).alias(name)
        for text, (name, f) in zip(texts[1:], spec.fields.items())
    ]
    row_key = F.coalesce(F.col("_key_id"), F.col(texts[0]).try_cast("long"))
    typed = read.select(
        *PLACE,
        "key",
        "message",
        row_key.alias(spec.key),
        *values,
        op.alias("__op"),
        F.col(texts[-2]).try_cast("long").alias(META[0]),
        F.col(texts[-1]).alias(META[1]),
    )
    known = F.coalesce(op_in(F.col("__op"), spec.ops), F.lit(False))
    reject = F.when(F.col(spec.key).isNull(), "no_key").when(~known, "unknown_op")
    if tombstones == "ignore":
        reject = F.when(F.col("message").isNull(), "tombstone").otherwise(reject)
    return typed.withColumn("reject", reject)


def accepted(parsed: DataFrame, spec: TableSpec) -> DataFrame:
    """Usable changes: the state columns, the operation and the place in the change order."""
    return parsed.filter(F.col("reject").isNull()).select(*spec.columns, "__op", *PLACE)


def quarantined(parsed: DataFrame) -> DataFrame:
    """Records that cannot be applied, with the reason. Ignored tombstones are not faults."""
    return parsed.filter(F.col("reject") != "tombstone").select(*PLACE, "key", "message", "reject")


def changes(raw: DataFrame, spec: TableSpec, **options: str) -> DataFrame:
    return accepted(parse(raw, spec, **options), spec)


def with_order(rows: DataFrame) -> DataFrame:
    """Fold the place columns into the one comparable ``_order`` column."""
    return rows.withColumn(ORDER, F.struct(*PLACE)).drop(*PLACE)


def state_columns(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return rows.select(*spec.columns)


def unwrap(
    raw: DataFrame, spec: TableSpec, drop_tombstones: bool = True, handle_deletes: bool = True
) -> DataFrame:
    """Flatten before/after envelopes into row messages with ``__op``, ``__source_ts_ms`` and
    ``__deleted``; a delete carries the row's last image. Works on raw-store rows.

    The outer envelope is read once for its parts, then only the image that is needed.
    """
    paths = [spec.key_path, *[f.path for f in spec.fields.values()]]
    types = ["long", *[_wire_type(f.type, spec) for f in spec.fields.values()]]
    texts = [f"_text_{i}" for i in range(len(paths))]
    image = F.when(F.col("_op") == DELETE, F.col("_before")).otherwise(F.col("_after"))
    read = (
        raw.select("*", F.json_tuple("message", "before", "after", "source", "op").alias(
            "_before", "_after", "_source", "_op"
        ))
        .select("*", F.json_tuple(image, *paths).alias(*texts))
        .select("*", F.json_tuple("_source", "ts_ms").alias("_ts_ms"))
    )
    row = {
        path: F.col(text) if kind == "string" else F.col(text).try_cast(kind)
        for path, text, kind in zip(paths, texts, types)
    }
    key = F.coalesce("key", message_key(row[spec.key_path], spec.key_path))
    op = F.col("_op")
    row |= {"__op": op, "__source_ts_ms": F.col("_ts_ms").try_cast("long"), "__deleted": deleted_flag(op)}
    value = F.when(F.col("message").isNotNull(), json_object(row))
    if drop_tombstones:
        read = read.filter(F.col("message").isNotNull())
    if not handle_deletes:
        read = read.filter(~op.eqNullSafe(DELETE))
    return read.select("partition", "offset", key.alias("key"), value.alias("message"), "kafka_timestamp")


def _wire_type(type_name: str, spec: TableSpec) -> str:
    """The type a field has inside a message: times keep the form they travel in."""
    if type_name != "timestamp":
        return type_name
    return "string" if spec.time_format == ISO else "long"
