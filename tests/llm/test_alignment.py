"""Alignment of two tokenizers against a plain version with the tokenizers' own libraries."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowtide.llm import alignment
from rowtide.llm.queries import BYTE_BPE, PIECES
from tests.llm.data import TEXTS, documents

MORE = [
    (20, "It's 12,345 dollars -- isn't it?\n\n\tÄpfel und 漢字 😀 é", "en"),
    (21, "<|endoftext|> is plain here, as are <s> and </s>", "en"),
    (22, "a▁b", "en"),
    (23, " leading and trailing  ", "en"),
    (24, "\x00\x01  x", "en"),
    (25, "x" * 3000, "en"),
    (26, " " * 150_000 + "end", "en"),
    (27, "one two one two one two", "en"),
    (28, "one two", "en"),
]


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def plain(text, a, b):
    """Ids of both and the groups, by comparing all ends."""
    as_byte = alignment.byte_characters()
    if not text:
        return [], [], []
    found = a.encode(" " + text, add_special_tokens=False)
    ids_a, tokens_a = found.ids, [bytes(as_byte[x] for x in token) for token in found.tokens]
    ids_b = b.encode(text)
    tokens_b = [bytes([int(p[3:5], 16)]) if b.is_byte(n) else p.replace("▁", " ").encode() for n in ids_b for p in [b.id_to_piece(n)]]
    if not b"".join(tokens_a) == b"".join(tokens_b) == b" " + text.encode():
        return [], [], []

    def ends(tokens):
        at, out = 0, []
        for token in tokens:
            at += len(token)
            out.append(at)
        return out

    ends_a, ends_b, groups, i, j = ends(tokens_a), ends(tokens_b), [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((ids_a[i:k], ids_b[j:m]))
        i, j = k, m
    return ids_a, ids_b, groups


def test_rows_are_those_of_the_plain_version(spark, tools, monkeypatch):
    texts = [(n, t, lang) for n, t, lang in TEXTS if n != 7] + MORE
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 100)
    found = alignment.aligned(documents(spark, texts).repartition(3), BYTE_BPE, PIECES).cache()
    n_b = alignment.n_pieces(spark, PIECES)
    got = alignment.weighed(found, alignment.pair_counts(found, n_b)).collect()
    want = [(n, *plain(t, *tools)) for n, t, _ in texts]
    counts = Counter((a[-1], b[-1]) for _, _, _, groups in want for a, b in groups)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    rows = []
    for n, ids_a, ids_b, groups in want:
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        rows.append(
            (n, len(ids_a), len(ids_b), text, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links))
        )
    have = [(x.doc_id, x.n_a, x.n_b, x.groups, x.n_links, x.n_best, x.count_sum) for x in got]
    assert sorted(have, key=str) == sorted(rows, key=str)
    by_id = {x.doc_id: x for x in got}
    assert by_id[22].n_a == 0 and by_id[22].groups == "" and by_id[21].n_a > 5 and by_id[26].n_a > 1000


def test_remembered_windows_change_nothing(tools):
    encoders = alignment.encoders(open(BYTE_BPE, "rb").read(), open(PIECES, "rb").read())
    texts = [t for _, t, _ in MORE] * 3
    first = [list(map(tuple, x)) for x in encoders.windows(*encoders.encoded(texts))]
    assert len(encoders.memo) > 10
    again = [list(map(tuple, x)) for x in encoders.windows(*encoders.encoded(texts))]
    encoders.memo.clear()
    assert first == again
    assert first[: len(MORE)] == first[len(MORE) : 2 * len(MORE)]


def test_empty_tables_and_long_texts(spark):
    none = alignment.aligned(documents(spark, []), BYTE_BPE, PIECES)
    assert alignment.weighed(none, alignment.pair_counts(none, 32000)).count() == 0
    blank = alignment.aligned(documents(spark, [(1, None, "en"), (1, "", "en")]), BYTE_BPE, PIECES)
    rows = alignment.weighed(blank, alignment.pair_counts(blank, 32000)).collect()
    assert [(x.n_a, x.groups, x.n_links, x.n_best, x.count_sum) for x in rows] == [(0, "", 0, 0, 0)] * 2
    long = alignment.aligned(documents(spark, [x for x in TEXTS if x[0] == 7]), BYTE_BPE, PIECES)
    row = long.select("n_a", F.size(F.split("groups", ";")).alias("n"), F.aggregate("times", F.lit(0).cast("long"), lambda x, y: x + y).alias("m")).first()
    assert row.n_a > 100_000 and row.n == row.m
