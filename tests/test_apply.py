import pytest
from pyspark.sql import functions as F

from rowtide.operators.compare import diff_snapshots, reconcile, reconcile_counts
from rowtide.operators.latest import latest_per_key
from rowtide.operators.merge import absorb, apply_changes, merge_actions, merge_into, stored_rows
from rowtide.operators.parse import changes, with_order
from rowtide.plans.jobs import newest_changes
from rowtide.sources.state import StateStore
from rowtide.spec import USERS
from tests.helpers import key, message, plan, raw_df, record, rows

STATE = "ID long, name string, email string, age int, created_at timestamp"


def state_df(spark, *people):
    return spark.createDataFrame([(i, n, None, a, None) for i, n, a in people], STATE)


def incoming(spark, *ops):
    rows_ = [(i, n, None, a, None, op) for i, n, a, op in ops]
    return spark.createDataFrame(rows_, STATE + ", __op string")


def latest(spark, *records, **options):
    return rows(latest_per_key(changes(raw_df(spark, *records), USERS, **options), "ID"), "ID", "__op")


def test_equal_times_are_decided_by_offset(spark):
    assert latest(spark, record(0, 7, key(1), message(1, "u")), record(0, 8, key(1), message(1, "d"))) == [(1, "d")]


def test_time_comes_before_offset(spark):
    late = record(0, 9, key(1), message(1, "u"), "2025-01-01 00:00:00")
    assert latest(spark, record(0, 8, key(1), message(1, "d"), "2025-01-02 00:00:00"), late) == [(1, "d")]


def test_tombstone_does_not_hide_the_delete(spark):
    records = record(0, 1, key(1), message(1, "d")), record(0, 2, key(1), None)
    assert latest(spark, *records) == [(1, "d")]
    assert latest(spark, record(0, 1, key(1), message(1, "u")), record(0, 2, key(1), None), tombstones="delete") == [
        (1, "d")
    ]


def test_unknown_op_does_not_hide_a_change(spark):
    assert latest(spark, record(0, 1, key(1), message(1, "u")), record(0, 2, key(1), message(1, "t"))) == [(1, "u")]


def test_merge_clauses(spark):
    state = state_df(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4), (5, "e", 5), (6, "f", 6))
    inc = incoming(
        spark,
        (1, "A", None, "u"),  # replaces the row, also with NULL
        (2, None, None, "d"),
        (3, "C", 9, "c"),
        (4, "D", 9, "r"),
        (5, "E", 9, None),  # no clause applies
        (7, "g", 7, "u"),  # inserted
        (8, "h", 8, "d"),  # ignored
        (9, "i", 9, None),  # ignored
    )
    merged = apply_changes(state, inc, USERS)
    assert rows(merged, "ID", "name", "age") == [
        (1, "A", None), (3, "C", 9), (4, "D", 9), (5, "e", 5), (6, "f", 6), (7, "g", 7)
    ]
    assert dict(rows(merge_actions(state, inc, USERS))) == {
        "update": 3, "delete": 1, "untouched": 2, "insert": 1, "ignored": 2
    }


def test_merge_has_one_row_per_key(spark):
    raw = raw_df(spark, *[record(0, n, key(n % 3), message(n % 3, "u", name=str(n))) for n in range(30)])
    merged = apply_changes(state_df(spark, (0, "x", 1), (9, "y", 2)), newest_changes(raw, USERS), USERS)
    assert rows(merged, "ID", "name") == [(0, "27"), (1, "28"), (2, "29"), (9, "y")]


def test_absorb_ignores_older_changes(spark):
    def stored(*records):
        return stored_rows(newest_changes(raw_df(spark, *records), USERS), USERS)

    base = stored(
        record(0, 5, key(1), message(1, "d")),
        record(0, 6, key(2), message(2, "u", name="new")),
        record(0, 7, key(3), message(3, "u", name="x")),
    )
    late = stored(
        record(0, 1, key(1), message(1, "u", name="revived")),
        record(0, 2, key(2), message(2, "u", name="old")),
        record(0, 8, key(3), message(3, "u", name="y")),
        record(0, 9, key(4), message(4, "d")),
    )
    got = rows(absorb(base, late, USERS), "ID", "name", "_deleted", "_order.offset")
    assert got == [(1, None, True, 5), (2, "new", False, 6), (3, "y", False, 8), (4, None, True, 9)]


@pytest.mark.parametrize("buckets", [None, 4])
def test_state_store(spark, tmp_path, buckets):
    store = StateStore(spark, str(tmp_path / "s"), USERS, buckets)
    assert not store.exists() and store.current().isEmpty()
    store.load(state_df(spark, (1, "a", 1), (2, "b", 2)))
    first = raw_df(spark, record(0, 0, key(2), message(2, "d")), record(1, 4, key(3), message(3, "c", name="c")))
    store.apply(newest_changes(first, USERS))
    assert rows(store.current(), "ID", "name") == [(1, "a"), (3, "c")]
    assert rows(store.applied_offsets()) == [(0, 1), (1, 5)]
    store.apply(newest_changes(first, USERS))
    assert rows(store.current(), "ID", "name") == [(1, "a"), (3, "c")]
    assert len(store.pending_deltas()) == 2
    store.compact()
    assert store.pending_deltas() == []
    assert rows(store.current(), "ID", "name") == [(1, "a"), (3, "c")]
    late = raw_df(spark, record(0, 9, key(2), message(2, "u", name="late"), "2024-01-01 00:00:00"))
    store.rebuild(newest_changes(late, USERS))
    assert rows(store.current(), "ID", "name") == [(1, "a"), (3, "c")]
    assert rows(store.applied_offsets()) == [(0, 1), (1, 5)]
    versions = store.versions()
    store.purge(keep=1)
    assert store.versions() == [max(versions)]
    assert rows(store.current(), "ID", "name") == [(1, "a"), (3, "c")]
    again = StateStore(spark, str(tmp_path / "s"), USERS, buckets)
    assert rows(again.current(), "ID", "name") == [(1, "a"), (3, "c")]


def test_bucketed_state_is_not_shuffled(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), USERS, buckets=4)
    store.load(state_df(spark, *[(i, "a", 1) for i in range(100)]))
    raw = raw_df(spark, *[record(0, n, key(n), message(n, "u")) for n in range(50, 150)])
    incoming = stored_rows(newest_changes(raw, USERS), USERS).repartition(4, "ID")
    merged = absorb(store.rows(), incoming, USERS)
    text = plan(merged)
    assert "Bucketed: true" in text
    # One to rank the changes, one to match them to the buckets, none for the table.
    assert text.count("Exchange hashpartitioning") == 2
    assert merged.count() == 150
    store.rebuild(newest_changes(raw, USERS))
    assert store.current().count() == 150


def test_deletes_only_make_an_empty_state(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), USERS)
    store.rebuild(newest_changes(raw_df(spark, record(0, 0, key(1), message(1, "d"))), USERS))
    assert store.exists() and store.current().isEmpty()


def test_half_written_version_is_not_read(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), USERS)
    store.load(state_df(spark, (1, "a", 1)))
    broken = tmp_path / "s" / "full=00000002"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    assert rows(store.current(), "ID") == [(1,)]
    assert store.compact() == 3
    assert rows(store.current(), "ID") == [(1,)]


def test_read_errors_are_not_taken_for_an_empty_table(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), USERS)
    number = store.load(state_df(spark, (1, "a", 1)))
    for file in (tmp_path / "s" / f"full={number:08d}").glob("*.parquet"):
        file.write_bytes(b"broken")
    with pytest.raises(Exception, match="(?i)parquet|crc|checksum|file"):
        store.current().collect()


def test_diff_and_reconcile(spark):
    before = state_df(spark, (1, "a", 1), (2, "b", 2), (3, "c", None))
    after = state_df(spark, (1, "a", 1), (3, "c", 3), (4, "d", None))
    diff = diff_snapshots(before, after, "ID", "users", F.lit("2025-01-01").cast("timestamp"))
    got = {r["record_id"]: r for r in diff.collect()}
    assert {k: r["operation"] for k, r in got.items()} == {2: "D", 3: "U", 4: "I"}
    assert got[2]["new_data"] is None and '"name":"b"' in got[2]["old_data"]
    assert '"age":null' in got[3]["old_data"] and '"age":3' in got[3]["new_data"]
    assert got[4]["old_data"] is None and got[4]["table_name"] == "users" and got[4]["processed"] is False
    assert rows(reconcile(after, before, "ID")) == [(2, "extra", None), (3, "different", "age"), (4, "missing", None)]
    assert rows(reconcile_counts(after, before, "ID")) == [("different", 1), ("extra", 1), ("missing", 1)]
    assert reconcile(after, after, "ID").isEmpty()


def test_merge_into_needs_a_table_format_with_row_changes(spark, tmp_path):
    """Parquet tables have no row-level merge; the statement itself is accepted."""
    inc = with_order(changes(raw_df(spark, record(0, 0, key(1), message(1, "u"))), USERS))
    spark.sql(f"CREATE TABLE merge_target ({STATE}) USING parquet LOCATION '{tmp_path}/t'")
    try:
        with pytest.raises(Exception, match="MERGE"):
            merge_into("merge_target", inc, USERS)
    finally:
        spark.sql("DROP TABLE merge_target")
