"""State tables whose spec gains columns."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rowtide.operators.latest import latest_per_key
from rowtide.operators.parse import changes, with_order
from rowtide.sources.state import StateStore
from rowtide.spec import USERS, Field
from tests.helpers import key, message, plan, raw_df, record, rows

WIDE = replace(USERS, fields={**USERS.fields, "city": Field("city")})


def newest(spark, spec, *messages):
    records = raw_df(spark, *[record(0, n, key(id), message(id, op, **more)) for n, id, op, more in messages])
    return with_order(latest_per_key(changes(records, spec), spec.key))


@pytest.mark.parametrize("buckets", [None, 2])
def test_a_new_column_is_null_in_older_versions(spark, tmp_path, buckets):
    path = str(tmp_path / "state")
    old, new = StateStore(spark, path, USERS, buckets), StateStore(spark, path, WIDE, buckets)
    old.rebuild(newest(spark, USERS, (0, 1, "c", {"name": "a"}), (1, 2, "c", {"name": "b"}), (2, 3, "c", {"name": "c"})))
    assert rows(new.current(), "ID", "city") == [(1, None), (2, None), (3, None)]
    new.apply(newest(spark, WIDE, (5, 2, "u", {"name": "b2", "city": "Bonn"})))
    assert rows(new.current(), "ID", "name", "city") == [(1, "a", None), (2, "b2", "Bonn"), (3, "c", None)]
    assert old.current().columns == USERS.columns and rows(old.current(more=True), "ID", "city") == rows(new.current(), "ID", "city")
    # A job with the older spec keeps the column of rows that it does not change.
    old.compact()
    assert rows(new.current(), "ID", "city") == [(1, None), (2, "Bonn"), (3, None)]
    old.apply(newest(spark, USERS, (7, 3, "d", {}), (8, 1, "u", {"name": "a2"})))
    old.rebuild(newest(spark, USERS, (9, 4, "c", {"name": "d"})))
    assert rows(new.current(), "ID", "name", "city") == [(1, "a2", None), (2, "b2", "Bonn"), (4, "d", None)]
    # A change replaces its row whole.
    old.apply(newest(spark, USERS, (11, 2, "u", {"name": "b3"})))
    assert rows(new.current().filter("ID = 2"), "name", "city") == [("b3", None)]


def test_integers_may_get_wider(spark, tmp_path):
    path = str(tmp_path / "state")
    wide = replace(USERS, fields={**USERS.fields, "age": Field("age", "long")})
    StateStore(spark, path, USERS).apply(newest(spark, USERS, (0, 1, "c", {"age": 30})))
    later = StateStore(spark, path, wide)
    later.apply(newest(spark, wide, (1, 2, "c", {"age": 2**40})))
    assert rows(later.current(), "ID", "age") == [(1, 30), (2, 2**40)]


def test_only_wanted_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "state")
    StateStore(spark, path, WIDE).rebuild(newest(spark, WIDE, (0, 1, "c", {"city": "Bonn", "name": "a"})))
    old = StateStore(spark, path, USERS)
    text = plan(old.current().select("ID", "name"))
    assert "city" not in text[text.index("ReadSchema") :]
    assert old.current().agg(F.count("*")).first()[0] == 1
