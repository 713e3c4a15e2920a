"""Operation codes and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Change-log operation to envelope operation (fixed values).
LOG_OPS = {"I": "c", "U": "u", "D": "d"}


def envelope_op(log_op: Column) -> Column:
    """``I``/``U``/``D`` to ``c``/``u``/``d``; any other code passes through."""
    mapped = F.create_map(*[F.lit(x) for pair in LOG_OPS.items() for x in pair])
    return F.coalesce(F.try_element_at(mapped, log_op), log_op)


def infer_op(created_at: Column, updated_at: Column) -> Column:
    """``c`` when both stamps lie less than a second apart, else (or when one is missing) ``u``."""
    gap = F.abs(F.unix_micros(updated_at) - F.unix_micros(created_at))
    return F.when(gap < 1_000_000, "c").otherwise("u")


def deleted_flag(op: Column) -> Column:
    return F.when(op == "d", "true").otherwise("false")
