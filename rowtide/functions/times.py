"""Timestamp encodings used by change envelopes. All functions assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_micros(micros: Column, precision: str = "microsecond") -> Column:
    """Epoch microseconds to timestamp; ``precision="second"`` drops the fraction."""
    ts = F.timestamp_micros(micros)
    return ts if precision == "microsecond" else F.date_trunc(precision, ts)


#: A date and a time of day at least to the minute; a fraction and a zone are free (fixed pattern).
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s?(Z|UTC|[+-]\d{2}(:?\d{2})?)?$"


def from_iso(text: Column) -> Column:
    """ISO text to timestamp, with or without fraction or zone; anything else is NULL."""
    return F.when(text.rlike(ISO_TEXT), F.try_to_timestamp(text))


def to_iso(ts: Column) -> Column:
    """Timestamp to ISO text: six fraction digits, or none for a whole second."""
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def decode_time(text: Column, encoding: str, precision: str = "microsecond") -> Column:
    if encoding == "iso":
        return from_iso(text)
    return from_micros(text.try_cast("long"), precision)


def encode_time(ts: Column, encoding: str) -> Column:
    return to_iso(ts) if encoding == "iso" else F.unix_micros(ts)
