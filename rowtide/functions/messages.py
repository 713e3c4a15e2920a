"""Building the JSON key and value of a change message."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# NULL fields stay in the message as JSON null; dropping them would change the row image.
_KEEP_NULLS = {"ignoreNullFields": "false"}


def json_object(values: Mapping[str, Column]) -> Column:
    return F.to_json(F.struct(*[c.alias(name) for name, c in values.items()]), _KEEP_NULLS)


def message_key(key: Column, path: str = "id") -> Column:
    return json_object({path: key})


def or_missing(value: Column, image: Column, path: str, missing: str | None) -> Column:
    """The value of a field of a JSON row image. ``missing`` stands in for an absent field; a
    field that is present as JSON null stays NULL. Only NULL values cost a second look."""
    if missing is None:
        return value
    present = F.coalesce(F.array_contains(F.json_object_keys(image), path), F.lit(False))
    return F.when(value.isNotNull(), value).when(~present, missing)
