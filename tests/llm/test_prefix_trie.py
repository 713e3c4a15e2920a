"""The prefix trie against a plain one, with bands of several heights."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rowtide.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, n int"


def table(spark, rows):
    return spark.createDataFrame([(*x, 1, "k", 2) for x in rows], SCHEMA)


def ordered(rows):
    """Turns of each conversation as the operator orders them."""
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    out = {}
    for c, turn, role, text in sorted(
        (x for x in rows if x[0] is not None), key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2] or "", md5(x[3]))
    ):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def plain(said):
    members = {}
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    rows = []
    for node, who in members.items():
        below = [x for x in members if x[: len(node)] == node]
        ends = sorted(c for c in who if len(said[c]) == len(node))
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        above = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        rows.append((min(who), len(node), above, len(who), len(kids.get(node, [])), sum(x not in kids for x in below), saved, digest))
    return sorted(rows, key=str)


def trie(spark, rows, height=prefix_trie.HEIGHT):
    conversations = table(spark, rows)
    turns, _ = prefix_trie.placed(conversations)
    ids = conversations.filter("conv_id IS NOT NULL").select("conv_id").distinct()
    found = prefix_trie.prefix_trie(turns, ids, height).drop("k1", "k2")
    return sorted((tuple(x) for x in found.collect()), key=str)


def some(seed, n=40, most=30):
    dice = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(dice.randint(1, most)):
            rows.append((c, turn, dice.choice("ua"), dice.choice(["hi", "hi there", ""]) if turn > 12 else "same words"))
    return rows


@pytest.mark.parametrize("height", [2, 16])
def test_totals(spark, height):
    rows = some(height)
    assert trie(spark, rows, height) == plain(ordered(rows))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, None, None, None),
        (1, 0, "u", "b"),
        (1, 0, "a", "b"),
        (1, 0, "a", "a"),
        (2, 1, "", ""),
        (2, 1, "", ""),
        (None, 1, "u", "lost"),
        (-3, 5, "", None),
        (3, 9, "", ""),
        (3, 10, "a", "long " * 5000),
    ]
    assert trie(spark, rows) == plain(ordered(rows))
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "u", "lost")]) == []


def test_long_conversations_are_spread(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 8)
    monkeypatch.setattr(prefix_trie, "IDS", 4)
    rows = [(7, n, "u", f"turn {n % 5}") for n in range(90)] + [(8, n, "u", f"turn {n % 5}") for n in range(70)]
    rows += [(c, 0, "u", "all alike") for c in range(20, 50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns, _ = prefix_trie.placed(table(spark, rows))
        assert trie(spark, rows) == plain(ordered(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    places = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.count_distinct("place").alias("m"), F.max("place").alias("top"))
    assert places.filter("n <> m OR top <> n - 1").isEmpty()
