"""Winnowing against a plain version of it."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rowtide.llm import fingerprint
from rowtide.llm.fingerprint import K, SPAN, STRETCH, WINDOW
from tests.llm.data import TEXTS, documents


def plain(grams: list[int]) -> list[tuple[int, int]]:
    """Least hash of every window, of equal ones the rightmost; each place once."""
    width = min(WINDOW, len(grams))
    found = []
    for start in range(len(grams) - width + 1 if grams else 0):
        place = min(range(start, start + width), key=lambda x: (grams[x], -x))
        if not found or found[-1][0] != place:
            found.append((place, grams[place]))
    return found


def hashed(spark, texts: list[str]) -> list[list[int]]:
    """Hashes of all grams, cut by substring; compared as signed numbers, turned round."""
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    grams = f"transform(sequence(0, greatest(length(text) - {K}, 0)), x -> shiftright(~xxhash64(encode(substring(text, x + 1, {K}), 'UTF-32')), 32))"
    rows = df.selectExpr("n", f"CASE WHEN text = '' THEN array() ELSE {grams} END AS grams").collect()
    return [x.grams for x in sorted(rows)]


def kept(column):
    return F.transform(
        column, lambda y: F.struct(F.shiftright(fingerprint._byte(y) - 1, 2).alias("p"), F.shiftright(F.bitwise_not(y), 32).alias("h"))
    )


SIZES = [0, 1, 2, K - 1, K, K + 1, SPAN - 1, SPAN, SPAN + 1, 2 * SPAN, 500, STRETCH + SPAN - 2, STRETCH + SPAN - 1, STRETCH + SPAN, 2600]


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(5)
    letters = ["ab", "abcdefgh ijkl", "é漢😀a", "a"]
    return ["".join(dice.choices(x, k=size)) for x in letters for size in SIZES for _ in range(2)]


def test_kept_hashes(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    rows = df.select("n", kept(fingerprint.winnowed(F.col("text"))).alias("kept")).collect()
    want = [plain(x) for x in hashed(spark, texts)]
    assert [[tuple(y) for y in x.kept] for x in sorted(rows)] == want


def test_joined_is_that_of_the_joined_text(spark, texts):
    dice = random.Random(6)
    pairs = [(n, *dice.choices(texts, k=2)) for n in range(150)]
    cut = [(n, a, b, dice.randint(0, len(a)), dice.randint(0, len(b))) for n, a, b in pairs]
    cut += [(150, texts[-1], "", 200, 0), (151, "", texts[-1], 0, 200), (152, texts[18], texts[48], SPAN, SPAN)]
    df = spark.createDataFrame(cut, "n int, a string, b string, i int, j int")
    whole = F.concat(F.substring("a", F.lit(1), F.col("i")), F.substring("b", F.lit(1), F.col("j")))
    parts = fingerprint.joined(
        F.col("a"), fingerprint.winnowed(F.col("a")), F.col("i"), F.col("b"), fingerprint.winnowed(F.col("b")), F.col("j")
    )
    for row in df.select("n", parts.alias("got"), fingerprint.winnowed(whole).alias("want")).collect():
        assert row.got == row.want, cut[row.n][3:]


def test_shared_stretches_share_a_hash(spark):
    dice = random.Random(7)
    for _ in range(5):
        one, other, both = ("".join(dice.choices("abcdefghij", k=size)) for size in (300, 200, SPAN))
        df = spark.createDataFrame([(one + both + other, other[:57] + both + one[:31])], "a string, b string")
        numbers = [fingerprint.hashes(fingerprint.winnowed(F.col(x))) for x in "ab"]
        assert df.select(F.size(F.array_intersect(*numbers))).first()[0] > 0


def test_every_document_and_its_next(spark):
    rows = sorted([x for x in TEXTS if x[0] != 7], key=lambda x: (x[0] is not None, x[0] or 0))
    texts = [x[1] or "" for x in rows]
    ids = [x[0] for x in rows]
    got = fingerprint.fingerprinted(documents(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows)
    # Rows of one id are ordered by a hash that only Spark knows: read their order from what they are edited with.
    hashes = {
        x.text: x.h for x in spark.createDataFrame([(x,) for x in set(texts)], "text string").select("text", F.xxhash64("text").alias("h")).collect()
    }
    order = sorted(range(len(rows)), key=lambda n: (ids[n] is not None, ids[n] or 0, hashes[texts[n]]))
    want = []
    for at, n in enumerate(order):
        after = texts[order[(at + 1) % len(order)]]
        half = len(texts[n]) // 2
        want.append((ids[n], len(texts[n]), texts[n][: len(texts[n]) - half] + after[:half]))
    assert sorted(((x.doc_id, x.n_chars, x.edited) for x in got), key=str) == sorted(want, key=str)
    grams = {t: {h for _, h in plain(g)} for t, g in zip([*texts, *(x.edited for x in got)], hashed(spark, [*texts, *(x.edited for x in got)]), strict=True)}
    mine = dict(zip([(i, len(t)) for i, t in zip(ids, texts, strict=True)], texts, strict=True))
    for row in got:
        a, b = grams[mine[row.doc_id, row.n_chars]], grams[row.edited]
        assert row.near_edited == (len(a & b) / len(a | b) if a | b else 1.0)
        assert 0 <= row.near_next <= 1


def test_empty_table_and_equal_texts(spark):
    assert fingerprint.fingerprinted(documents(spark, [])).count() == 0
    one = fingerprint.fingerprinted(documents(spark, [(3, "abc def", "en")])).collect()
    assert [(x.doc_id, x.edited, x.near_next) for x in one] == [(3, "abc abc", 1.0)]
    got = fingerprint.fingerprinted(documents(spark, [(1, "same text " * 30, "en"), (2, "same text " * 30, None), (9, None, None)])).collect()
    by_id = {x.doc_id: x for x in got}
    assert by_id[1].near_next == 1.0 and by_id[1].numbers == by_id[2].numbers and by_id[9].numbers == []
    assert hashlib.sha256(by_id[2].edited.encode()).hexdigest() == hashlib.sha256(("same text " * 15).encode()).hexdigest()


def test_many_repeated_rows_are_one_in_the_shuffle(spark):
    rows = [(7, "again and again " * 20, "en")] * 400 + [(n, f"text {n} " * 30, "en") for n in range(8, 12)]
    got = fingerprint.fingerprinted(documents(spark, rows).repartition(4)).collect()
    assert len(got) == 404 and sum(x.near_next == 1.0 for x in got if x.doc_id == 7) == 399
