"""Two tokenizers aligned on the bytes of each text.

Every text is encoded whole by a byte-level BPE (A) and by a piece model (B). Where the tokens of both end at one
byte and the next token of both is marked by a space, the text is cut: these anchors split it into windows of A ids
and B ids. A token's bytes depend on its id alone, so the alignment of a window depends on its two tuples of ids
alone; it is worked out once for each pair of tuples that a task meets and looked up after that.

Inside a window the places where tokens of both end cut its tokens into groups. Every group links its last A token
with its last B token, which end together. No token of the two vocabularies is empty, so these are all such pairs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.frames import col, kept
from rowtide.llm.text import cuts, strings

#: Bytes of text encoded at a time; a longer text is encoded alone.
SLICE_BYTES = 1 << 19
#: Longest text, in characters, for the faster encoder.
LONG = 100_000
#: How byte-level vocabularies of this kind cut a text before they merge (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Window alignments a task remembers before it starts anew, and the most ids in a remembered window.
MEMO, MEMO_IDS = 200_000, 64
#: Marks ids of B in the key of a window.
OF_B = 1 << 30
#: Pairs of ids whose counts are sent at a time.
BLOCK_PAIRS = 2_000_000


class Vocabulary(NamedTuple):
    """Bytes of each id's token, their number, and whether they begin with a space."""

    tokens: pa.Array
    sizes: np.ndarray
    spaced: np.ndarray


def vocabulary(tokens: list[bytes]) -> Vocabulary:
    return Vocabulary(pa.array(tokens, pa.binary()), np.array([len(x) for x in tokens]), np.array([x[:1] == b" " for x in tokens]))


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: printable characters for themselves, the
    other bytes in order by the characters from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(rest)}


def same(texts: list[bytes], ids: list[np.ndarray], side: Vocabulary) -> bool:
    """Whether the tokens of each text's ids are, joined, the text."""
    every = np.concatenate(ids)
    ends = np.concatenate([[0], np.cumsum(side.sizes[every])])[np.cumsum([len(x) for x in ids])]
    if ends.tolist() != np.cumsum([len(x) for x in texts]).tolist():
        return False
    _, places, data = side.tokens.take(pa.array(every)).buffers()
    joined = b"".join(texts)
    return not joined or data.to_pybytes()[: len(joined)] == joined


class Stretches(NamedTuple):
    """Places of all rows of some windows, one window after the other, and where each begins and ends among them."""

    at: np.ndarray
    ends: np.ndarray


def stretches(bounds: np.ndarray, which: np.ndarray) -> Stretches:
    sizes = bounds[which + 1] - bounds[which]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return Stretches(np.repeat(bounds[which] - ends[:-1], sizes) + np.arange(ends[-1]), ends)


def shared(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which of ``mine`` are in ``other``; both ascend."""
    place = np.searchsorted(other, mine)
    place[place == len(other)] = 0
    return other[place] == mine if len(other) else np.zeros(len(mine), bool)


class Encoders:
    """Both tokenizers and the alignment of their windows.

    The ids of A come from a faster encoder that reads the same vocabulary, its merges ranked by id. It cannot take very long
    runs of white space, so texts of more than ``LONG`` characters go through the vocabulary's own library. Both give the same ids.
    """

    def __init__(self, byte_bpe: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken

        self.byte_bpe = byte_bpe.decode()
        model = json.loads(self.byte_bpe)
        as_byte, names = byte_characters(), model["model"]["vocab"]
        ranks = {bytes(as_byte[x] for x in name): number for name, number in names.items()}
        merged = [names["".join(x) if isinstance(x, list) else x.replace(" ", "")] for x in model["model"]["merges"]]
        if merged != sorted(merged) or model["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level vocabulary whose ids rank its merges is needed")
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        # Special tokens have ids too, but no text is encoded to them.
        tokens = [b""] * (max([*ranks.values(), *(x["id"] for x in model["added_tokens"])]) + 1)
        for token, number in ranks.items():
            tokens[number] = token
        self.of_a = vocabulary(tokens)
        self.of_b = vocabulary([self._piece(x) for x in range(self.b.get_piece_size())])
        ids = [str(x) for x in range(len(tokens))], [str(x) for x in range(self.b.get_piece_size())]
        # Every id as text twice: inside a group's side, and at its end.
        self.names = pa.array([x + y for side, last in zip(ids, "|;", strict=True) for x in side for y in ("," + last)])
        # Tuples of text and bytes only: Python's garbage collector does not go through them again and again.
        self.memo: dict[bytes, tuple[str, bytes]] = {}

    @cached_property
    def of_long(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_str(self.byte_bpe)
        found.encode_special_tokens = True
        return found

    def ids_a(self, text: str) -> np.ndarray:
        if len(text) > LONG:
            return np.array(self.of_long.encode(text, add_special_tokens=False).ids, np.int32)
        return self.a.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    @cached_property
    def of_long(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_str(self.byte_bpe)
        found.encode_special_tokens = True
        return found

    def ids_a(self, text: str) -> np.ndarray:
        if len(text) > LONG:
            return np.array(self.of_long.encode(text, add_special_tokens=False).ids, np.int32)
        return self.a.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def encoded(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text; none of either if the tokens' bytes are not a space and the text."""
        of_a = [self.ids_a(" " + x) for x in texts]
        of_b = [np.array(x, np.int32) for x in self.b.encode(texts, num_threads=1)]
        whole = [b" " + x.encode() for x in texts]
        alike = all(texts) and all(same(whole, ids, side) for ids, side in ((of_a, self.of_a), (of_b, self.of_b)))
        for n in () if alike else range(len(texts)):
            if not texts[n] or not (same(whole[n : n + 1], of_a[n : n + 1], self.of_a) and same(whole[n : n + 1], of_b[n : n + 1], self.of_b)):
                of_a[n] = of_b[n] = np.zeros(0, np.int32)
        return of_a, of_b

    def align(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[tuple[str, bytes]]:
        """The groups of each window as text, every group closed by a semicolon, and the code of each group's link
        as int64: A id x size of B + B id. Window n has the ids ``a[at_a[n]:at_a[n + 1]]`` and ``b[at_b[n]:at_b[n + 1]]``."""
        end_a, end_b = np.cumsum(self.of_a.sizes[a]), np.cumsum(self.of_b.sizes[b])
        last_a, last_b = shared(end_a, end_b), shared(end_b, end_a)
        codes = a[last_a].astype(np.int64) * len(self.of_b.tokens) + b[last_b]
        # In the text a group's A ids stand before its B ids, so an id comes after all of the other side's earlier groups.
        ends_a, ends_b = (np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (last_a, last_b))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + ends_b[np.cumsum(last_a) - last_a]] = 2 * a + last_a
        order[np.arange(len(b)) + ends_a[np.cumsum(last_b) - last_b + 1]] = 2 * (b + len(self.of_a.tokens)) + last_b
        text = self.names.take(pa.array(order))
        _, places, data = text.buffers()
        places = np.frombuffer(places, np.int32, len(order) + 1)
        text, raw = data.to_pybytes()[: places[-1]].decode(), codes.tobytes()
        of_text = places[at_a + at_b].tolist()
        of_code = (8 * np.concatenate([[0], np.cumsum(last_a)])[at_a]).tolist()
        return [
            (text[i:j], raw[k:m])
            for i, j, k, m in zip(of_text, of_text[1:], of_code, of_code[1:], strict=False)
        ]

    def windows(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> Iterator[list[tuple[str, bytes]]]:
        """The aligned windows of each text."""
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        end_a, end_b = np.cumsum(self.of_a.sizes[a]), np.cumsum(self.of_b.sizes[b])
        start_a, start_b = end_a - self.of_a.sizes[a], end_b - self.of_b.sizes[b]
        anchors = np.intersect1d(start_a[self.of_a.spaced[a]], start_b[self.of_b.spaced[b]], assume_unique=True)
        # A text's own first tokens begin with its space, so texts are cut from each other too.
        texts = np.concatenate([[0], end_a])[np.concatenate([[0], np.cumsum([len(x) for x in ids_a])])]
        at_a = np.concatenate([np.searchsorted(start_a, anchors), [len(a)]])
        at_b = np.concatenate([np.searchsorted(start_b, anchors), [len(b)]])
        # A window's ids of A, then those of B, set off by a high bit: the two tuples of ids as one key.
        ids = np.empty(len(a) + len(b), np.int32)
        ids[np.arange(len(a)) + np.repeat(at_b[:-1], np.diff(at_a))] = a
        ids[np.arange(len(b)) + np.repeat(at_a[1:], np.diff(at_b))] = b | OF_B
        raw, bounds = ids.tobytes(), (4 * (at_a + at_b)).tolist()
        keys = [raw[i:j] for i, j in zip(bounds, bounds[1:], strict=False)]
        found = [self.memo.get(x) for x in keys]
        unmet: dict[bytes, int] = {}
        for n, known in enumerate(found):
            if known is None:
                unmet.setdefault(keys[n], n)
        which = np.fromiter(unmet.values(), np.int64, len(unmet))
        part_a, part_b = stretches(at_a, which), stretches(at_b, which)
        aligned = self.align(a[part_a.at], b[part_b.at], part_a.ends, part_b.ends)
        new = dict(zip(unmet, aligned, strict=True))
        found = [new[keys[n]] if known is None else known for n, known in enumerate(found)]
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
        self.memo.update((k, v) for k, v in new.items() if len(k) <= 4 * MEMO_IDS)
        first = np.searchsorted(anchors, texts).tolist()
        for low, high in zip(first, first[1:], strict=False):
            yield found[low:high]


@lru_cache(maxsize=1)
def encoders(byte_bpe: bytes, pieces: bytes) -> Encoders:
    return Encoders(byte_bpe, pieces)


def file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file of a few MB, by Spark's reader."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def aligned(documents: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """A row per document (repeated rows too): ``doc_id, n_a, n_b``, the ``groups`` of token ids as text
    (``a1,a2|b1;a3|b2,b3``), and the ``codes`` of its links, each once and ascending, with the ``times`` each occurs.

    ``byte_bpe`` and ``pieces`` are paths of vocabulary files. Special tokens' strings in a text are plain text. A
    null or empty text, and one that the tokens of A or B do not give back byte for byte, has no tokens and no
    groups. Nothing is shuffled; a text is encoded whole.
    """
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast((file(spark, byte_bpe), file(spark, pieces)))
    schema = "doc_id long, n_a long, n_b long, groups string, codes array<long>, times array<long>"

    def align(batches):
        with_ = encoders(*sent.value)
        for batch in batches:
            _, at = strings(batch.column("text"))
            for low, high in cuts(np.diff(at), SLICE_BYTES):
                piece = batch.slice(low, high - low)
                ids_a, ids_b = with_.encoded([x or "" for x in piece.column("text").to_pylist()])
                groups, codes, times = [], [], []
                for found in with_.windows(ids_a, ids_b):
                    groups.append("".join([x for x, _ in found])[:-1])
                    code, n = np.unique(np.frombuffer(b"".join([x for _, x in found]), np.int64), return_counts=True)
                    codes.append(code)
                    times.append(n)
                ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in codes])]), pa.int32())
                columns = [
                    piece.column("doc_id"),
                    pa.array([len(x) for x in ids_a], pa.int64()),
                    pa.array([len(x) for x in ids_b], pa.int64()),
                    pa.array(groups, pa.string()),
                    *(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int64())) for x in (codes, times)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "groups", "codes", "times"])

    return documents.select(col("doc_id").cast("long").alias("doc_id"), col("text").alias("text")).mapInArrow(align, schema)


def n_pieces(spark: SparkSession, pieces: str) -> int:
    """The size of vocabulary B, by which ``codes`` are read."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=file(spark, pieces)).get_piece_size()


def pair_counts(found: DataFrame, n_b: int) -> DataFrame:
    """``code, n, best``: how many links of all documents hold a pair of ids, and whether no other pair with its B id
    has more. Task by task links are summed up before they are shuffled."""
    links = found.select(F.explode(F.arrays_zip("codes", "times")).alias("link"))
    pairs = links.groupBy(F.col("link.codes").alias("code")).agg(F.sum("link.times").alias("n"))
    pairs, _ = kept(pairs, "pairs")
    most = pairs.groupBy((F.col("code") % n_b).alias("b")).agg(F.max("n").alias("most"))
    joined = pairs.withColumn("b", F.col("code") % n_b).join(most, "b")
    return joined.select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def weighed(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``found`` with ``n_links``, ``n_best`` (links that are best for their B id) and ``count_sum`` (over links, the
    count of their pair) in place of ``codes`` and ``times``.

    The counts go out in blocks of about ``BLOCK_PAIRS`` pairs, however many there are; documents are not shuffled.
    """
    spark = found.sparkSession
    counts, _ = kept(counts, "counts")
    blocks = max(1, -(-counts.count() // BLOCK_PAIRS))
    sums = [F.lit(0).cast("long").alias(x) for x in ("n_best", "count_sum")]
    out = found.select("*", F.aggregate("times", F.lit(0).cast("long"), lambda x, y: x + y).alias("n_links"), *sums)
    schema = out.schema
    for number in range(blocks):
        if number:
            out, _ = kept(out, "weighed")
        part = counts.filter(F.pmod(F.xxhash64("code"), F.lit(blocks)) == number).toArrow().sort_by("code")
        sent = spark.sparkContext.broadcast([part.column(x).to_numpy() for x in ("code", "n", "best")])

        def weigh(batches, sent=sent):
            code, n, best = sent.value
            for batch in batches:
                links = batch.column("codes")
                mine, times = links.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
                row = np.repeat(np.arange(len(batch)), links.value_lengths().fill_null(0).to_numpy())
                place = np.minimum(np.searchsorted(code, mine), max(len(code) - 1, 0))
                known = code[place] == mine if len(code) else np.zeros(len(mine), bool)
                place, times, row = place[known], times[known], row[known]
                for name, values in (("n_best", times * best[place]), ("count_sum", times * n[place])):
                    added = np.zeros(len(batch), np.int64)
                    np.add.at(added, row, values)
                    column = pa.array(batch.column(name).to_numpy() + added)
                    batch = batch.set_column(batch.schema.get_field_index(name), name, column)
                yield batch

        out = out.mapInArrow(weigh, schema)
    return out.drop("codes", "times")
