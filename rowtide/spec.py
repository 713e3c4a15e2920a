"""What a captured table looks like: fields, encodings, accepted operations, fixed schemas."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes of the change envelope (fixed values).
SNAPSHOT, CREATE, UPDATE, DELETE = "r", "c", "u", "d"

# Bookkeeping columns that keep a state row's place in the change order.
ORDER, DELETED = "_order", "_deleted"

# A change's place in the order of changes: total for the changes of a key.
PLACE = ("kafka_timestamp", "partition", "offset")
STORED_PLACE = tuple(f"{ORDER}.{column}" for column in PLACE)

# Fixed schemas of the stored tables.
TOPIC_SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
RAW_SCHEMA = "partition int, offset long, key string, message string, kafka_timestamp timestamp"
CHANGELOG_SCHEMA = (
    "change_id long, table_name string, operation string, record_id long, "
    "old_data string, new_data string, changed_at timestamp, processed boolean"
)
OFFSETS_SCHEMA = "partition int, next_offset long"
ORDER_TYPE = "struct<kafka_timestamp:timestamp,partition:int,offset:long>"

MICROS, ISO = "micros", "iso"


@dataclass(frozen=True)
class Field:
    """A state column: the JSON name it travels under, its type, and the text a capture
    writes when the source row lacks it."""

    path: str
    type: str = "string"
    missing: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """How one table's envelopes map to its state table.

    ``stamp`` names the creation-time field; it is the one a capture fills from the change
    time when the row has none. ``time_format`` says how timestamps travel: epoch
    microseconds or ISO text.
    """

    fields: Mapping[str, Field] = field(default_factory=dict)
    key: str = "ID"
    key_path: str = "id"
    ops: tuple[str, ...] = (SNAPSHOT, CREATE, UPDATE, DELETE)
    time_format: str = MICROS
    stamp: str | None = "created_at"

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.fields]

    @property
    def upserts(self) -> tuple[str, ...]:
        return tuple(op for op in self.ops if op != DELETE)

    @property
    def state_schema(self) -> str:
        cols = ", ".join(f"`{name}` {f.type}" for name, f in self.fields.items())
        return f"`{self.key}` long, {cols}"

    @property
    def stored_schema(self) -> str:
        """State rows with their bookkeeping columns."""
        return f"{self.state_schema}, {DELETED} boolean, {ORDER} {ORDER_TYPE}"


def op_in(column: Column, ops: tuple[str, ...]) -> Column:
    """Membership that is NULL for a NULL operation, so that neither branch claims it."""
    return column.isin(*ops) if ops else F.lit(False)


_USERS_FIELDS = {
    "name": Field("name", missing=""),
    "email": Field("email", missing=""),
    "age": Field("age", "int"),
    "created_at": Field("created_at", "timestamp"),
}

USERS = TableSpec(_USERS_FIELDS)
USERS_ISO = TableSpec(_USERS_FIELDS, ops=(CREATE, UPDATE, DELETE), time_format=ISO)
