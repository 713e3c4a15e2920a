"""Benchmark decontamination by suffix arrays over the training texts.

Each task cuts its documents into shards of bounded text and sorts the shard's suffixes, word by
word, into a suffix array. Every suffix of a benchmark item is then binary-searched in it: the two
bounds of its first ``window`` words give all verbatim occurrences, the neighbours of its place the
longest verbatim match. Suffixes that cannot take part are left out of the array: those that meet a
word no item holds before the shortest window is full.

Nothing is shuffled. The benchmark is sent to the tasks in blocks of ``BLOCK_BYTES`` of text, one
after the other, so its size is free; a document carries what earlier blocks found in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.frames import col, kept
from rowtide.llm.text import Words, slices, words

WINDOW = 13
BLOCK_BYTES = 4 << 20


@dataclass
class Tests:
    """Words of a block of items as small numbers (0: a word of no item), and their windows."""

    vocabulary: np.ndarray
    present: np.ndarray
    tokens: np.ndarray
    items: np.ndarray
    rows: list[str]
    names: list[str]
    windows: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray
    owner_ends: np.ndarray

    @property
    def bits(self) -> int:
        return max(1, len(self.vocabulary).bit_length())

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.present[(hashes >> np.uint64(44)).astype(np.int64)])
        if len(self.vocabulary):
            near = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            out[maybe] = np.where(self.vocabulary[near] == hashes[maybe], near + 1, 0)
        return out


def tests(names: list[str], found: Words, window: int) -> Tests:
    """Names are sorted as strings; rows of one name are one item."""
    order = sorted(set(names))
    rank = {name: place for place, name in enumerate(order)}
    vocabulary = np.unique(found.hashes)
    present = np.zeros(1 << 20, bool)
    present[(vocabulary >> np.uint64(44)).astype(np.int64)] = True
    tokens = np.searchsorted(vocabulary, found.hashes) + 1
    counts = np.diff(found.docs)
    n = np.maximum(counts - window + 1, np.minimum(counts, 1))
    starts = np.repeat(found.docs[:-1] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
    ends = np.repeat(found.docs[1:], n)
    wide = np.minimum(starts + window, ends)
    padded = np.concatenate([tokens, np.zeros(window, np.int64)])
    rows = padded[starts[:, None] + np.arange(window)]
    rows[np.arange(window) >= (wide - starts)[:, None]] = 0
    windows, which = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, starts)
    owner = np.repeat(np.array([rank[x] for x in names], np.int64), n)
    pairs = np.unique(np.stack([which.ravel(), owner], 1), axis=0) if len(rows) else np.zeros((0, 2), np.int64)
    return Tests(
        vocabulary,
        present,
        tokens,
        found.docs,
        names,
        order,
        windows,
        (windows > 0).sum(1),
        pairs[:, 1],
        np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1)),
    )


@dataclass
class Shard:
    """Suffix array of a few documents: ``order`` holds the places in ``tokens``, sorted by what follows."""

    tokens: np.ndarray
    places: np.ndarray
    order: np.ndarray
    keys: np.ndarray
    depth: int
    bits: int

    @property
    def per(self) -> int:
        return 62 // self.bits

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """The first words of each row as one number that sorts alike."""
        out = np.zeros(len(rows), np.int64)
        for step in range(self.per):
            out <<= self.bits
            if step < rows.shape[1]:
                out |= rows[:, step]
        return out


def _packed(tokens: np.ndarray, at: np.ndarray, per: int, bits: int) -> np.ndarray:
    out = np.zeros(len(at), np.int64)
    for step in range(per):
        out = (out << bits) | tokens[at + step]
    return out


def shard(numbers: np.ndarray, docs: np.ndarray, bits: int, least: int, depth: int) -> Shard:
    """Sort the suffixes that begin with ``least`` known words by their first ``depth`` words.

    Documents are set apart by a 0. Words are packed several to a number; each round sorts on by the
    next few words only what the rounds before left equal.
    """
    places = np.arange(len(numbers)) + np.repeat(np.arange(len(docs) - 1), np.diff(docs))
    per = 62 // bits
    tokens = np.zeros(len(numbers) + len(docs) + depth + per, np.int64)
    tokens[places] = numbers
    stops = np.flatnonzero(tokens == 0)
    at = np.flatnonzero(tokens)
    run = stops[np.searchsorted(stops, at)] - at
    order = at[run >= least]
    first = _packed(tokens, order, per, bits)
    by = np.argsort(first, kind="stable")
    order, keys = order[by], first[by]
    group = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]])) if len(keys) else keys
    for skip in range(per, depth, per):
        tied = np.zeros(len(order), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        more = _packed(tokens, np.minimum(order[rows] + skip, len(tokens) - per), per, bits)
        by = np.lexsort((more, group[rows]))
        order[rows] = order[rows][by]
        more, old = more[by], group[rows]
        new = np.zeros(len(order), np.int64)
        new[rows[1:]] = (old[1:] == old[:-1]) & (more[1:] != more[:-1])
        step = np.concatenate([[0], (group[1:] != group[:-1]).astype(np.int64)])
        group = np.cumsum(step | new)
    return Shard(tokens, places, order, keys, depth, bits)


def _bound(index: Shard, rows: np.ndarray, lengths: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all rows at once: the first suffix not before (or, ``after``, beyond) each."""
    low = np.zeros(len(rows), np.int64)
    high = np.full(len(rows), len(index.order), np.int64)
    width = np.arange(rows.shape[1])
    last = len(index.tokens) - 1
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        suffix = index.tokens[np.minimum(index.order[middle][:, None] + width, last)]
        wanted = rows[open_]
        differ = (suffix != wanted) & (width < lengths[open_][:, None])
        place = differ.argmax(1)
        line = np.arange(len(open_))
        equal = ~differ[line, place]
        less = suffix[line, place] < wanted[line, place]
        up = np.where(equal, after, less)
        low[open_[up]] = middle[up] + 1
        high[open_[~up]] = middle[~up]


def occurrences(index: Shard, block: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Window and place of each verbatim occurrence. Windows whose first words begin no suffix of
    the shard are set aside by one search of the suffixes in the sorted windows."""
    keys = index.pack(block.windows)
    some = block.lengths < index.per
    if len(index.order):
        own = np.unique(index.keys)
        low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        marks = np.zeros(len(keys) + 1, np.int64)
        np.add.at(marks, low, 1)
        np.add.at(marks, high, -1)
        some = some | (np.cumsum(marks[:-1]) > 0)
    chosen = np.flatnonzero(some) if len(index.order) else np.zeros(0, np.int64)
    rows, lengths = block.windows[chosen], block.lengths[chosen]
    low, high = _bound(index, rows, lengths, False), _bound(index, rows, lengths, True)
    n = high - low
    at = np.repeat(low - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
    return np.repeat(chosen, n), index.order[at]


def _merged(start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in any stretch."""
    marks = np.zeros(size + 1, np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, end, -1)
    return np.cumsum(marks[:-1]) > 0


def _ranges(hit: np.ndarray) -> np.ndarray:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edges.reshape(-1, 2)


def find(block: Tests, column, hits: list[bytes | None], items: list[list[str] | None]):
    """Per text: number of words, of hit words, stretches of hit words (packed pairs of int32), items hit."""
    found = words(column)
    numbers = block.numbers(found.hashes)
    least = int(block.lengths.min()) if len(block.lengths) else 1
    depth = block.windows.shape[1]
    index = shard(numbers, found.docs, block.bits, least, depth)
    which, at = occurrences(index, block)
    word = np.searchsorted(index.places, at)
    doc = np.searchsorted(found.docs, word, "right") - 1
    pairs = np.unique(np.stack([doc, which], 1), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
    n = block.owner_ends[pairs[:, 1] + 1] - block.owner_ends[pairs[:, 1]]
    place = np.repeat(block.owner_ends[pairs[:, 1]] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
    owned = np.stack([np.repeat(pairs[:, 0], n), block.owners[place]], 1)
    owned = np.unique(owned, axis=0) if len(place) else np.zeros((0, 2), np.int64)
    by_doc = np.searchsorted(owned[:, 0], np.arange(len(found.docs)))
    marked = _merged(word, word + block.lengths[which], len(numbers))
    touched = set(np.unique(doc).tolist())
    out_n, out_hits, out_items = [], [], []
    for row in range(len(found.docs) - 1):
        before, names = hits[row] or b"", items[row] or []
        if row in touched:
            low, high = found.docs[row], found.docs[row + 1]
            hit = marked[low:high].copy()
            for start, end in np.frombuffer(before, np.int32).reshape(-1, 2):
                hit[start:end] = True
            before = _ranges(hit).astype(np.int32).tobytes()
            names = sorted({*names, *(block.names[x] for x in owned[by_doc[row] : by_doc[row + 1], 1])})
        out_n.append(int(np.diff(np.frombuffer(before, np.int32).reshape(-1, 2)).sum()))
        out_hits.append(before)
        out_items.append(names)
    return np.diff(found.docs), out_n, out_hits, out_items


def blocks(benchmark: DataFrame, window: int, limit: int = BLOCK_BYTES) -> Iterator[Tests]:
    """The benchmark in blocks of at most ``limit`` bytes of text (or one longer item), one at a time."""
    rows = benchmark.select(
        F.coalesce(col("item_id").cast("string"), F.lit("")).alias("name"), col("text").alias("text")
    ).filter("text IS NOT NULL")
    size = F.octet_length("text") + F.octet_length("name") + 16
    n = 1
    while True:
        part = F.pmod(F.xxhash64("name", "text"), F.lit(n))
        worst = rows.groupBy(part.alias("part")).agg(F.sum(size).alias("size"), F.count_distinct("name", "text").alias("n"))
        worst = worst.filter("n > 1").agg(F.max("size")).first()[0]
        if worst is None or worst <= limit:
            break
        n *= 2
    for number in range(n):
        block = rows.filter(part == number).distinct().toArrow()
        yield tests(block.column("name").to_pylist(), words(block.column("text")), window)


def mark(rows: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``rows`` has one column, ``row``, a struct that holds ``text``. Adds ``n_words``, ``n_hit``, ``hits``
    (stretches of hit words as packed pairs of int32: begin, end) and ``items`` (sorted as strings)."""
    spark = rows.sparkSession
    out = rows.select(
        "row",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.lit(None).cast("binary").alias("hits"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    schema = out.schema
    for number, block in enumerate(blocks(benchmark, window)):
        if number:
            out, _ = kept(out, "marked")
        sent = spark.sparkContext.broadcast(block)

        def scan(batches, sent=sent):
            def column(piece):
                return pc.struct_field(piece.column("row"), text)

            for batch in batches:
                for piece in slices(batch, column):
                    before = piece.column("hits").to_pylist(), piece.column("items").to_pylist()
                    counts, n_hit, hits, items = find(sent.value, column(piece), *before)
                    columns = [
                        piece.column("row"),
                        pa.array(counts, pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        pa.array(hits, pa.binary()),
                        pa.array(items, pa.list_(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "n_hit", "hits", "items"])

        out = out.mapInArrow(scan, schema)
    return out


def contaminated(share: int = 20) -> Column:
    """The contract's rule: at least one word in ``share`` is hit."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def report(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row per document (repeated rows too): how much of it is verbatim benchmark text, and of which items.

    Null text has no words. An item without an id goes by the empty name; items of one id are one
    item; an item without text is none. ``spans`` are the hit words, as [begin, end) word numbers.
    """
    rows = documents.select(F.struct(col("doc_id").alias("doc_id"), col("text").alias("text")).alias("row"))
    found = mark(rows, benchmark, window=window)
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
        "items",
        F.hex("hits").alias("spans"),
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with all their columns, that are not contaminated."""
    rows = documents.select(F.struct(*[col(name) for name in documents.columns]).alias("row"))
    return mark(rows, benchmark, window=window).filter(~contaminated()).select("row.*")


def _longest(index: Shard, block: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Length and place of a longest verbatim match of every benchmark suffix in the shard."""
    size = np.repeat(block.items[1:], np.diff(block.items)) - np.arange(len(block.tokens))
    padded = np.concatenate([block.tokens, np.zeros(index.depth, np.int64)])
    train = np.concatenate([index.tokens, np.zeros(index.depth, np.int64)])
    width = np.arange(index.depth)
    best, where = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for low in range(0, len(size), step := max(1, (1 << 20) // index.depth)):
        lengths = size[low : low + step]
        rows = padded[np.arange(low, low + len(lengths))[:, None] + width]
        place = _bound(index, rows, lengths, False)
        for beside in (place - 1, place):
            near = index.order[np.clip(beside, 0, len(index.order) - 1)]
            differ = (train[near[:, None] + width] != rows) | (width >= lengths[:, None])
            match = np.where(differ.any(1), differ.argmax(1), index.depth)
            more = match > best[low : low + len(lengths)]
            best[low : low + len(lengths)][more] = match[more]
            where[low : low + len(lengths)][more] = near[more]
    return best, where


def longest_matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For every benchmark suffix (item, first word) that matches at all: the length in words of its longest
    verbatim match in the documents, and one place of it (doc_id, word; of several, the least)."""
    spark = documents.sparkSession
    rows = documents.select(col("doc_id").cast("string").alias("doc_id"), col("text").alias("text"))
    schema = "item string, suffix long, length long, doc_id string, word long"
    parts = []
    for block in blocks(benchmark, 1):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches, sent=sent):
            block = sent.value
            depth = max(1, int(np.diff(block.items).max(initial=1)))
            best = [(0, "", 0)] * len(block.tokens)
            for batch in batches:
                for piece in slices(batch, lambda x: x.column("text")):
                    found = words(piece.column("text"))
                    index = shard(block.numbers(found.hashes), found.docs, block.bits, 1, depth)
                    if not len(index.order):
                        continue
                    length, at = _longest(index, block)
                    ids = piece.column("doc_id").to_pylist()
                    word = np.searchsorted(index.places, at)
                    doc = np.searchsorted(found.docs, word, "right") - 1
                    for n in np.flatnonzero(length).tolist():
                        if length[n] > best[n][0]:
                            best[n] = (int(length[n]), ids[doc[n]] or "", int(word[n] - found.docs[doc[n]]))
            item = np.repeat(np.arange(len(block.items) - 1), np.diff(block.items))
            rows = [
                (block.rows[item[n]], int(n - block.items[item[n]]), *found)
                for n, found in enumerate(best)
                if found[0]
            ]
            if rows:
                columns = [pa.array(x) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "suffix", "length", "doc_id", "word"])

        parts.append(rows.mapInArrow(scan, schema))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    place = F.struct((-F.col("length")).alias("l"), F.col("doc_id"), F.col("word"))
    best = found.groupBy("item", "suffix").agg(F.min(place).alias("best"))
    return best.select(
        "item", "suffix", (-F.col("best.l")).alias("length"), F.col("best.doc_id").alias("doc_id"), F.col("best.word").alias("word")
    )
