"""Random histories: the order of arrival, repeats and slicing must not matter."""

import random

import pytest

from rowtide.operators.parse import decode
from rowtide.plans import jobs
from rowtide.sources.raw import RawStore
from rowtide.sources.state import StateStore
from rowtide.spec import USERS
from tests.helpers import key, message, raw_df, record, rows, topic_df


def history(seed: int, size: int = 120):
    """Changes of twelve keys over three partitions, with tied times, a hot key and faults."""
    rng = random.Random(seed)
    offsets = [0, 0, 0]
    for _ in range(size):
        id = 0 if rng.random() < 0.4 else rng.randrange(1, 12)
        partition = id % 3
        at = f"2025-01-01 00:00:{rng.randrange(6):02d}"
        kind = rng.random()
        if kind < 0.05:
            text = None
        elif kind < 0.1:
            text = rng.choice(["oops", "{}", message(id, "t")])
        else:
            text = message(id, rng.choice("rcuudd"), name=str(rng.random()), age=rng.choice([None, 3, "x"]))
        yield record(partition, offsets[partition], key(id), text, at)
        offsets[partition] += rng.choice([1, 1, 3])


def expected(records) -> list[tuple]:
    """The state by brute force."""
    import json

    newest = {}
    for partition, offset, k, text, at in records:
        try:
            body = json.loads(text) if text is not None else {}
        except ValueError:
            body = {}
        if body.get("__op") not in ("r", "c", "u", "d"):
            continue
        id = json.loads(k)["id"]
        if id not in newest or newest[id][0] < (at, partition, offset):
            newest[id] = ((at, partition, offset), body)
    return sorted(
        (id, body["name"]) for id, (_, body) in newest.items() if body["__op"] != "d"
    )


def state_of(store: StateStore) -> list[tuple]:
    return sorted(rows(store.current(), "ID", "name"))


@pytest.mark.parametrize("seed", range(2))
def test_state_matches_brute_force(spark, tmp_path, seed):
    records = list(history(seed))
    rng = random.Random(seed)
    want = expected(records)

    replay = StateStore(spark, str(tmp_path / "replay"), USERS)
    shuffled = rng.sample(records, len(records))
    replay.rebuild(jobs.newest_changes(raw_df(spark, *shuffled), USERS))
    assert state_of(replay) == want

    # Any pieces in any order, some of them twice.
    cuts = sorted(rng.sample(range(1, len(records)), 3))
    pieces = [shuffled[a:b] for a, b in zip([0, *cuts], [*cuts, len(records)])]
    pieces += rng.sample(pieces, 2)
    late = StateStore(spark, str(tmp_path / "late"), USERS)
    for n, piece in enumerate(pieces):
        late.apply(jobs.newest_changes(raw_df(spark, *piece), USERS))
        if n == 2:
            late.compact()
    assert state_of(late) == want

    # Landed and applied slice by slice.
    raw, incremental = RawStore(spark, str(tmp_path / "raw")), StateStore(spark, str(tmp_path / "inc"), USERS)
    for upto in (40, 90, len(records), len(records)):
        jobs.land(topic_df(spark, *records[:upto]), raw)
        jobs.materialize(raw, incremental, USERS, "incremental")
    assert rows(raw.read()) == rows(decode(topic_df(spark, *records)))
    assert state_of(incremental) == want
    jobs.materialize(raw, incremental, USERS, "replay")
    assert state_of(incremental) == want
