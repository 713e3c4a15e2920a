"""Source rows to change messages: snapshot, change log and polling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.messages import json_object, message_key, or_missing
from rowtide.functions.ops import deleted_flag, envelope_op, infer_op
from rowtide.functions.times import encode_time, from_iso, to_iso
from rowtide.spec import DELETE, ISO, SNAPSHOT, TableSpec


def _table_fields(spec: TableSpec, time_format: str, stamp_default: str | None = None) -> dict[str, Column]:
    fields = {}
    for name, f in spec.fields.items():
        value = F.col(name)
        if f.type == "timestamp":
            if stamp_default and name == spec.stamp:
                value = F.coalesce(value, F.col(stamp_default))
            value = encode_time(value, time_format)
        fields[f.path] = value
    return fields


def with_key(rows: DataFrame, column: str, spec: TableSpec) -> DataFrame:
    """Rows with their message key, which decides where a message goes."""
    return rows.withColumn("key", message_key(F.col(column), spec.key_path))


def snapshot_messages(table: DataFrame, spec: TableSpec, at: Column | None = None, *keep: str) -> DataFrame:
    """Every row of a table as a message with operation ``r``."""
    op, at = F.lit(SNAPSHOT), F.current_timestamp() if at is None else at
    row = {spec.key_path: F.col(spec.key), **_table_fields(spec, spec.time_format)}
    row |= {"__op": op, "__source_ts_ms": F.unix_millis(at), "__deleted": deleted_flag(op)}
    return table.select(
        *keep,
        message_key(F.col(spec.key), spec.key_path).alias("key"),
        json_object(row).alias("value"),
        at.alias("timestamp"),
    )


def needed_image(changelog: DataFrame) -> DataFrame:
    """Change-log rows without the row image that their message does not use."""
    is_delete = envelope_op(F.col("operation")).eqNullSafe(DELETE)
    return changelog.withColumns(
        {"old_data": F.when(is_delete, F.col("old_data")), "new_data": F.when(~is_delete, F.col("new_data"))}
    )


def changelog_envelope(changelog: DataFrame, spec: TableSpec, *keep: str) -> DataFrame:
    """Change-log rows as typed envelope columns, before they are rendered.

    A delete takes the old row image, anything else the new one; an image that is missing
    counts as empty. The creation stamp falls back to the time of the change.
    """
    op = envelope_op(F.col("operation"))
    image = F.when(op == DELETE, F.col("old_data")).otherwise(F.col("new_data"))
    texts = [f"_text_{i}" for i in range(len(spec.fields))]
    rows = (
        changelog.withColumn("__op", op)
        .withColumn("_image", image)
        .select("*", F.json_tuple("_image", *[f.path for f in spec.fields.values()]).alias(*texts))
    )
    fields = []
    for text, (name, f) in zip(texts, spec.fields.items()):
        value = or_missing(F.col(text), F.col("_image"), f.path, f.missing)
        if name == spec.stamp:
            own = F.coalesce(value, to_iso(F.col("changed_at")))
            value = F.when(own != "", own)
        if f.type == "timestamp" and spec.time_format != ISO:
            # Row images hold ISO text; it travels as the table's messages do.
            value = encode_time(from_iso(value), spec.time_format)
        if f.type not in ("string", "timestamp"):
            value = value.try_cast(f.type)
        fields.append(value.alias(name))
    return rows.select(
        *keep,
        "change_id",
        "changed_at",
        F.col("record_id").alias(spec.key),
        *fields,
        "__op",
        F.unix_millis("changed_at").alias("__source_ts_ms"),
        deleted_flag(F.col("__op")).alias("__deleted"),
    )


def render_envelope(envelope: DataFrame, spec: TableSpec, at: str, *keep: str) -> DataFrame:
    """Typed envelope columns to message key and value; times in ``envelope`` are encoded."""
    row = {spec.key_path: F.col(spec.key), **{f.path: F.col(n) for n, f in spec.fields.items()}}
    row |= {name: F.col(name) for name in ("__op", "__source_ts_ms", "__deleted")}
    return envelope.select(
        *keep,
        message_key(F.col(spec.key), spec.key_path).alias("key"),
        json_object(row).alias("value"),
        F.coalesce(F.col(at), F.current_timestamp()).alias("timestamp"),
    )


def changelog_messages(changelog: DataFrame, spec: TableSpec, *keep: str) -> DataFrame:
    envelope = changelog_envelope(changelog, spec, *keep)
    return render_envelope(envelope, spec, "changed_at", "change_id", "changed_at", *keep)


def poll_messages(
    polled: DataFrame, spec: TableSpec, updated: str, *keep: str, deleted: str | None = None
) -> DataFrame:
    envelope = poll_envelope(polled, spec, updated, *keep, deleted=deleted)
    return render_envelope(envelope, spec, updated, spec.key, updated, *keep)


def gone_messages(gone: DataFrame, spec: TableSpec, at: Column, *keep: str) -> DataFrame:
    """Delete messages for keys whose rows are no more; there is no image left to send."""
    fields = [F.lit(None).cast("string").alias(name) for name in spec.fields]
    envelope = gone.select(
        *keep,
        F.col(spec.key),
        *fields,
        F.lit(DELETE).alias("__op"),
        F.unix_millis(at).alias("__source_ts_ms"),
        deleted_flag(F.lit(DELETE)).alias("__deleted"),
        at.alias("_at"),
    )
    return render_envelope(envelope, spec, "_at", spec.key, *keep)


def poll_envelope(
    polled: DataFrame, spec: TableSpec, updated: str = "updated_at", *keep: str, deleted: str | None = None
) -> DataFrame:
    """Polled rows as typed envelope columns. The operation is inferred from the stamps, times
    travel as the spec says, and the creation stamp falls back to the update stamp. ``deleted`` names a column that
    marks deleted rows: a flag, or the time of deletion."""
    op = infer_op(F.col(spec.stamp), F.col(updated))
    if deleted:
        mark = F.col(deleted)
        gone = mark if polled.schema[deleted].dataType.simpleString() == "boolean" else mark.isNotNull()
        op = F.when(gone, DELETE).otherwise(op)
    fields = _table_fields(spec, spec.time_format, stamp_default=updated)
    return polled.select(
        *keep,
        F.col(spec.key),
        F.col(updated),
        *[fields[f.path].alias(name) for name, f in spec.fields.items()],
        op.alias("__op"),
        F.unix_micros(updated).alias("__source_ts_ms"),
        deleted_flag(op).alias("__deleted"),
    )
