"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity, connected groups.

1. One pass cuts texts into lines and gives each normalised line (its words, one blank apart) a 128-bit key
   and a 64-bit SimHash of its words, weighted by length. Equal lines become one.
2. Two SimHashes within ``DISTANCE`` bits agree on all bits of some ``BLOCKS - DISTANCE`` of ``BLOCKS``
   blocks. Lines meet on each such choice of blocks; in a task those within the distance are linked.
3. Lines that hang together so are read again and verified: a link holds if the SimHashes are within the
   distance and the edit similarity of the lines is ``SIMILARITY`` or more. Lines that hang together already
   are not compared again.
4. Of each connected group the first occurrence stays (least doc_id, then text hash, then line number).

Lines without a word are no occurrence of anything and always stay.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.frames import col, drop, halves, kept, whole_groups
from rowtide.llm.graph import components
from rowtide.llm.text import BLANK, hash_sequences, hash_spans, lowered, mix, slices, spans, strings

DISTANCE, BLOCKS = 3, 5
SIMILARITY = 0.8
#: Most lines of a bucket, and characters of a group, that one task compares at once. A line counts for
#: at least LIGHT characters.
BUCKET, GROUP, LIGHT = 4096, 1 << 22, 1024
#: Sizes of buckets are taken from one line in so many.
SAMPLED = 64
#: A word weighs as many as its bytes, at most so many.
HEAVY = 8

KEY = "struct<a:bigint,b:bigint>"


def _cut(column):
    """Lower-cased bytes, bounds of the lines in them, and the lines of each text."""
    raw, at = strings(column)
    breaks = np.flatnonzero(raw == 10) + 1
    bounds = np.unique(np.concatenate([at, breaks]))
    # A text that is empty, or ends in a line break, ends in an empty line, which has no word to lose.
    first = np.searchsorted(bounds, at)
    return lowered(raw), bounds, first


#: Two counters of 32 bits in a 64-bit number: no line has words enough to fill one.
PAIR = np.uint64(1 << 32 | 1)


def simhash(hashes: np.ndarray, weights: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """For each line with a word: the bits that words of more than half its weight have."""
    starts = lines[:-1][np.diff(lines) > 0]
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    weights = weights.astype(np.uint64)
    whole = np.add.reduceat(weights, starts)
    for bit in range(32):
        shift, high = np.uint64(bit), np.uint64(32)
        sums = np.add.reduceat((hashes >> shift & PAIR) * weights, starts)
        out |= (2 * (sums & np.uint64(0xFFFFFFFF)) > whole).astype(np.uint64) << shift
        out |= (2 * (sums >> high) > whole).astype(np.uint64) << shift + high
    return out


def lines_of(documents: DataFrame) -> DataFrame:
    """A row per line with a word: ``doc_id, text_id, line`` (from 0), ``a, b`` (its key), ``sim``, ``size``."""
    rows = documents.select(col("doc_id").alias("doc_id"), col("text").alias("text"), F.xxhash64(col("text")).alias("text_id"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_id long, line long, a long, b long, sim long, size long"

    def cut(batches):
        for batch in batches:
            for piece in slices(batch, lambda x: x.column("text")):
                low, bounds, first = _cut(piece.column("text"))
                start, end = spans(low, bounds)
                hashes = hash_spans(low, start, end)
                lines = np.searchsorted(start, bounds)
                some = np.flatnonzero(np.diff(lines))
                sim = simhash(hashes, np.minimum(end - start, HEAVY), lines)
                keys = [hash_sequences(x, lines)[some].astype(np.int64) for x in (hashes, mix(hashes + np.uint64(1)))]
                size = np.add.reduceat(end - start + 1, lines[some]) - 1 if len(some) else some
                doc = np.searchsorted(first, some, "right") - 1
                columns = [
                    piece.column("doc_id").take(pa.array(doc)),
                    piece.column("text_id").take(pa.array(doc)),
                    pa.array(some - first[doc]),
                    *map(pa.array, keys),
                    pa.array(sim.astype(np.int64)),
                    pa.array(size.astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_id", "line", "a", "b", "sim", "size"])

    return rows.mapInArrow(cut, schema)


def _masks() -> list[int]:
    """For each choice of blocks, the bits of a SimHash that are in them."""
    edges = [64 * n // BLOCKS for n in range(BLOCKS + 1)]
    block = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    masks = [sum(x) for x in combinations(block, BLOCKS - DISTANCE)]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def _close(sims: np.ndarray, row: int, others: np.ndarray) -> np.ndarray:
    return others[np.bitwise_count(sims[others] ^ sims[row]) <= DISTANCE]


def link(sims: np.ndarray, side: np.ndarray, same=None) -> list[tuple[int, int]]:
    """Links that join what is within the distance (and the ``same``), each joining two parts."""
    label, links = np.arange(len(sims)), []
    apart = side.min() != side.max()
    for row in range(len(sims)):
        others = np.flatnonzero(label != label[row])
        if apart:
            others = others[side[others] != side[row]]
        for x in _close(sims, row, others).tolist():
            if label[x] != label[row] and (same is None or same(row, x)):
                links.append((row, x))
                label[label == label[x]] = label[row]
    return links


def _key(rows: pa.Table, at: list[int]) -> pa.StructArray:
    at = pa.array(at, pa.int64())
    return pa.StructArray.from_arrays([rows.column(x).combine_chunks().take(at) for x in ("a", "b")], ["a", "b"])


def candidates(lines: DataFrame) -> DataFrame:
    """Links between lines whose SimHashes are within the distance."""
    spark = lines.sparkSession
    blocks = [F.xxhash64(F.lit(n), F.col("sim").bitwiseAND(F.lit(mask))) for n, mask in enumerate(_masks())]
    places = lines.select(F.explode(F.array(*blocks)).alias("block"), "sim", "a", "b")
    part = F.pmod(F.xxhash64("a", "b", F.lit("sample")), F.lit(SAMPLED)) == 0
    sampled = places.filter(part).groupBy("block").agg((F.count("*") * SAMPLED).alias("size"))
    # Small enough for Spark to broadcast, or else joined otherwise: a row per bucket with many lines.
    hot, _ = kept(sampled.filter(F.col("size") > BUCKET), "hot")
    dealt = halves(places.join(hot, "block", "left").fillna(1, "size").withColumn("id", F.struct("a", "b")), "id", "size", BUCKET)
    unit = ["block", "low_block", "high_block"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = dealt.select(*unit, "mine", "sim", "a", "b").repartition(parts, *unit).sortWithinPartitions(*unit, "sim")

    def meet(batches):
        for rows, starts in whole_groups(batches, *unit):
            mine = rows.column("mine").to_numpy()
            sims, size = rows.column("sim").to_numpy().view(np.uint64), np.diff(starts)
            begins = starts[:-1]
            two = begins[size == 2]
            close = two[np.bitwise_count(sims[two] ^ sims[two + 1]) <= DISTANCE]
            found = list(zip(close.tolist(), (close + 1).tolist(), strict=True))
            for begin, n in zip(begins[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                own = slice(begin, begin + n)
                found.extend((begin + a, begin + b) for a, b in link(sims[own], mine[own]))
            columns = [_key(rows, [pair[k] for pair in found]) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["low", "high"])

    return placed.mapInArrow(meet, f"low {KEY}, high {KEY}")


def distance(a: str, b: str) -> int:
    """Levenshtein distance; the rows of the table are the bits of whole numbers."""
    low, most = 0, min(len(a), len(b))
    while low < most and a[low] == b[low]:
        low += 1
    a, b = a[low:], b[low:]
    tail, most = 0, min(len(a), len(b))
    while tail < most and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for n, letter in enumerate(a):
        where[letter] = where.get(letter, 0) | 1 << n
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = every, 0, len(a)
    for letter in b:
        match = where.get(letter, 0)
        diagonal = ((((match & up) + up) ^ up) | match | down) & every
        right = down | (every & ~(diagonal | up))
        left = diagonal & up
        score += bool(right & last) - bool(left & last)
        right, left = (right << 1 | 1) & every, (left << 1) & every
        up, down = left | (every & ~(diagonal | right)), right & diagonal
    return score


def similar(a: str, b: str, least: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    if abs(len(a) - len(b)) > (1 - least) * longest + 1e-9:
        return False
    return distance(a, b) <= (1 - least) * longest + 1e-9


def verified(documents: DataFrame, lines: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between lines that are within the distance and similar."""
    spark = documents.sparkSession
    id_ = F.struct("a", "b")
    picked = lines.select(id_.alias("id"), "a", "b", "sim", "size", "first").join(groups, "id")
    size = F.sum(F.greatest("size", F.lit(LIGHT))).alias("group_size")
    picked = picked.join(picked.groupBy("component").agg(size), "component")
    each = F.collect_list(F.struct(F.col("first.line").alias("line"), "a", "b", "sim", "component", "group_size")).alias("wanted")
    wanted = picked.groupBy(F.col("first.doc_id").alias("own"), F.col("first.text_id").alias("own_text")).agg(each)
    texts = documents.select(col("doc_id").alias("doc_id"), col("text").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.xxhash64("text") == F.col("own_text"))
    found = texts.join(wanted, same).select("text", "wanted")
    schema = f"component {KEY}, group_size long, a long, b long, sim long, line string"

    def read(batches):
        for batch in batches:
            for piece in slices(batch, lambda x: x.column("text")):
                low, bounds, first = _cut(piece.column("text"))
                out = []
                for row, wanted in enumerate(piece.column("wanted").to_pylist()):
                    for x in wanted:
                        at = first[row] + x["line"]
                        words = low[bounds[at] : bounds[at + 1]].tobytes().split()
                        line = b" ".join(words).decode("utf-8", "replace")
                        out.append((x["component"], x["group_size"], x["a"], x["b"], x["sim"], line))
                kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])
                kinds = [kind, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                columns = [pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["component", "group_size", "a", "b", "sim", "line"])

    read_lines = found.mapInArrow(read, schema)
    once = read_lines.groupBy("a", "b", "component", "group_size", "sim").agg(F.first("line").alias("line"))
    dealt = halves(once.withColumn("id", id_), "id", "group_size", GROUP)
    unit = ["ca", "cb", "low_block", "high_block"]
    dealt = dealt.withColumn("ca", F.col("component.a")).withColumn("cb", F.col("component.b"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select(*unit, "mine", "a", "b", "sim", "line").repartition(parts, *unit).sortWithinPartitions(*unit, "a", "b")

    def check(batches):
        for rows, starts in whole_groups(batches, *unit):
            sims, mine = rows.column("sim").to_numpy().view(np.uint64), rows.column("mine").to_numpy()
            lines, out = rows.column("line").to_pylist(), []
            for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if end - begin < 2:
                    continue

                def same(a, b, begin=begin):
                    return similar(lines[begin + a], lines[begin + b])

                out.extend((begin + a, begin + b) for a, b in link(sims[begin:end], mine[begin:end], same))
            yield pa.RecordBatch.from_arrays([_key(rows, [pair[k] for pair in out]) for k in (0, 1)], ["low", "high"])

    return dealt.mapInArrow(check, f"low {KEY}, high {KEY}")


def line_groups(documents: DataFrame) -> DataFrame:
    """A row per line with a word (of repeated rows too): ``doc_id, text_id, line``; ``keep_doc, keep_text,
    keep_line``, the first occurrence of its group; ``group_lines``, the group's lines; ``kept``."""
    rows, _ = kept(lines_of(documents), "lines")
    first = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_id", "line")
    lines = rows.groupBy("a", "b").agg(
        F.min(first).alias("first"), F.count("*").alias("n"), F.first("sim").alias("sim"), F.first("size").alias("size")
    )
    lines, lines_at = kept(lines, "distinct")
    groups, groups_at = components(candidates(lines))
    joined, joined_at = components(verified(documents, lines, groups))
    id_ = F.struct("a", "b").alias("id")
    member = lines.select(id_, "first", "n").join(joined, "id")
    whole = member.groupBy("component").agg(F.min("first").alias("group_first"), F.sum("n").alias("group_n"))
    linked = member.select("id", "component").join(whole, "component")
    linked, _ = kept(linked.select(F.col("id.a").alias("a"), F.col("id.b").alias("b"), "group_first", "group_n"), "linked")
    every, _ = kept(
        lines.select("a", "b", "first", "n").join(linked, ["a", "b"], "left").select(
            "a", "b", F.coalesce("group_first", "first").alias("first"), F.coalesce("group_n", "n").alias("group_lines")
        ),
        "groups",
    )
    drop(lines, lines_at, groups_at, joined_at)
    found = rows.select("doc_id", "text_id", "line", "a", "b").join(every, ["a", "b"])
    mine = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_id", "line")
    return found.select(
        "doc_id", "text_id", "line",
        F.col("first.doc_id").alias("keep_doc"),
        F.col("first.text_id").alias("keep_text"),
        F.col("first.line").alias("keep_line"),
        "group_lines",
        mine.eqNullSafe(F.col("first")).alias("kept"),
    )


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents, with all their columns, their texts without the lines that do not stay. Repeated rows
    (of one doc_id and text) keep the same lines. Texts that lose nothing are as they were, null included."""
    lost = line_groups(documents).filter("NOT kept").select("doc_id", "text_id", "line").distinct()
    lost = lost.groupBy(F.col("doc_id").alias("own"), F.col("text_id").alias("own_text")).agg(F.collect_set("line").alias("lost"))
    names = documents.columns
    rows = documents.select(F.struct(*[col(x) for x in names]).alias("row"), F.xxhash64(col("text")).alias("text_id"))
    same = F.col("row.doc_id").eqNullSafe(F.col("own")) & (F.col("text_id") == F.col("own_text"))
    lines = F.split(F.col("row.text"), "\n", -1)
    left = F.array_join(F.filter(lines, lambda _, n: ~F.array_contains(F.col("lost"), n.cast("long"))), "\n")
    text = F.when(F.col("lost").isNull(), F.col("row.text")).otherwise(left)
    found = rows.join(lost, same, "left").withColumn("clean", text)
    return found.select(*[F.col("clean").alias(x) if x == "text" else F.col("row")[x].alias(x) for x in names])
