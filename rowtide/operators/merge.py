"""Applying one change per key to a keyed state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.spec import DELETE, DELETED, ORDER, TableSpec, op_in

STATE, CHANGE = "s_", "c_"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(quoted(c)).alias(prefix + c) for c in df.columns])


def pair(state: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """State and change rows side by side per key (``s_*`` and ``c_*``; NULL where one is absent).

    One full outer join: each side is read once and meets on the key. A state that is bucketed by
    the key is not shuffled.
    """
    s, c = _prefixed(state, STATE), _prefixed(changes, CHANGE)
    return s.join(c, F.col(quoted(STATE + key)) == F.col(quoted(CHANGE + key)), "full_outer")


def _either(changed: Column, name: str) -> Column:
    return F.when(changed, F.col(quoted(CHANGE + name))).otherwise(F.col(quoted(STATE + name))).alias(name)


def _action(spec: TableSpec) -> Column:
    """What happens to each pair. A NULL or unaccepted operation leaves a state row alone."""
    has_state, has_change = F.col(quoted(STATE + spec.key)).isNotNull(), F.col(quoted(CHANGE + spec.key)).isNotNull()
    op = F.col(CHANGE + "__op")
    return (
        F.when(~has_change, "untouched")
        .when(has_state & op_in(op, spec.upserts), "update")
        .when(has_state & (op == DELETE), "delete")
        .when(has_state, "untouched")
        .when(op != DELETE, "insert")
        .otherwise("ignored")
    )


def apply_changes(state: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Keyed merge: update or delete on match, insert what is new unless it is a delete.

    ``changes`` holds at most one row per key. An update replaces the whole row, also with
    NULLs, and an update of an absent key inserts it.
    """
    columns = [*spec.columns, "__op"]
    pairs = pair(state.select(*spec.columns), changes.select(*columns), spec.key)
    acted = pairs.withColumn("_action", _action(spec)).filter(~F.col("_action").isin("delete", "ignored"))
    taken = F.col("_action") != "untouched"
    return acted.select(
        *[_either(taken, c) for c in spec.columns]
    )


def merge_actions(state: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Row count of each action the merge would take; reads only keys and operations."""
    pairs = pair(state.select(spec.key), changes.select(spec.key, "__op"), spec.key)
    return pairs.groupBy(_action(spec).alias("action")).agg(F.count("*").alias("n"))


def stored_rows(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Ordered changes as store rows: a delete stays as a marked row of its key and order only."""
    gone = F.col("__op") == DELETE
    images = [F.when(gone, F.lit(None)).otherwise(F.col(quoted(c))).alias(c) for c in spec.fields]
    return changes.select(quoted(spec.key), *images, gone.alias(DELETED), ORDER)


def absorb(rows: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """Merge store rows with newer store rows, one per key on each side.

    A row replaces another only if its order is not older, so applying the same change again,
    or a late one, changes nothing, and a late update cannot bring back a deleted key. Both sides have the same
    columns, which may be more than those of the spec.
    """
    pairs = pair(rows, incoming, spec.key)
    wins = F.col(quoted(CHANGE + spec.key)).isNotNull() & (
        F.col(quoted(STATE + spec.key)).isNull()
        | F.col(STATE + ORDER).isNull()
        | (F.col(CHANGE + ORDER) >= F.col(STATE + ORDER))
    )
    wins = F.coalesce(wins, F.lit(False))
    return pairs.select(*[_either(wins, c) for c in rows.columns])


def merge_into(table: str, changes: DataFrame, spec: TableSpec, evolve: bool = False) -> None:
    """The same merge on a catalog table whose format supports row-level MERGE; with ``evolve`` columns that the
    table lacks are added to it."""
    source = changes.select(*spec.columns, "__op").alias("inc")
    op = F.col("inc.__op")
    images = {c: F.col(f"inc.{c}") for c in spec.fields}
    merge = source.mergeInto(table, F.expr(f"{table}.`{spec.key}` = inc.`{spec.key}`"))
    if evolve:
        merge = merge.withSchemaEvolution()
    (
        merge.whenMatched(op_in(op, spec.upserts))
        .update(images)
        .whenMatched(op == DELETE)
        .delete()
        .whenNotMatched(op != DELETE)
        .insert({spec.key: F.col(f"inc.{spec.key}"), **images})
        .merge()
    )
