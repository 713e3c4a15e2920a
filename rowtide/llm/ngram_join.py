"""Similarity join of texts: Jaccard similarity of word n-grams, by a MinHash LSH forest.

1. One pass gives each text the hash of its n-gram set and a MinHash signature; equal sets become one.
2. The forest has ``TREES`` prefix tries over ``DEPTH`` signature values each. Texts that share a prefix
   meet; in a task the signatures are sorted, so a trie's nodes are stretches of rows. Matched prefixes are
   shortened from the full depth until the recall at the threshold reaches ``RECALL`` (see ``least_depth``).
   Texts that meet are screened by all signature values, which leaves threads of candidates, not pairs.
3. Candidates that hang together are verified against each other exactly, all pairs, in blocks of bounded
   size, so a group of near copies of any size is compared in full while only counts and a spanning
   forest of the verified links leave a task.
4. Links are joined to classes.

A text of fewer words than the n-gram's, but not none, is one n-gram. Texts without a word have no link.
Sets are compared by 64-bit hashes of their n-grams.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.frames import col, drop, halves, kept, whole_groups
from rowtide.llm.graph import components
from rowtide.llm.text import Words, mix, shingles, slices, words

WIDTH = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 8
RECALL = 0.9995
#: Standard errors of a similarity estimate by which a candidate may fall short of the threshold.
SLACK = 4.5
#: Most texts of a trie node, and n-grams of a group of candidates, that one task compares at once. A text
#: counts for at least LIGHT n-grams.
NODE, GROUP, LIGHT = 2048, 1 << 20, 1024

_ROUNDS = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64))
_FLIP = (_ROUNDS & np.uint64(0xFFFFFFFF)).astype(np.uint32)
_SPREAD = (_ROUNDS >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def least_depth(threshold: float, recall: float) -> int:
    """The longest prefix at which a pair of ``threshold`` meets in some tree with chance ``recall``."""
    deep = [d for d in range(1, DEPTH + 1) if 1 - (1 - threshold**d) ** TREES >= recall]
    return max(deep, default=1)


def signatures(found: Words) -> np.ndarray:
    """For each text with a shingle, the least value of each of the hash functions over its shingles."""
    starts = found.docs[:-1][np.diff(found.docs) > 0]
    out = np.zeros((len(starts), TREES * DEPTH), np.uint32)
    short = (found.hashes >> np.uint64(32)).astype(np.uint32)
    if len(starts):
        for n, (flip, spread) in enumerate(zip(_FLIP, _SPREAD, strict=True)):
            out[:, n] = np.minimum.reduceat((short ^ flip) * spread, starts)
    return out


def _fixed(rows: np.ndarray) -> list[bytes]:
    size = rows.shape[1]
    flat = np.ascontiguousarray(rows).tobytes()
    return [flat[x : x + size] for x in range(0, len(flat), size)]


SIGNED = "doc_id {}, text_id long, key binary, n long, paths array<long>, rests binary, low binary"


def signed(documents: DataFrame, depth: int, width: int = WIDTH) -> DataFrame:
    """Per row: ``key`` (hash of the n-gram set, null without words), its size ``n``, and the signature as
    ``paths`` (a number for the shortest prefix in each tree), ``rests`` (what follows it) and ``low`` (a byte
    of each value)."""
    rows = documents.select(col("doc_id").alias("doc_id"), col("text").alias("text"), F.xxhash64(col("text")).alias("text_id"))

    def sign(batches):
        for batch in batches:
            for piece in slices(batch, lambda x: x.column("text")):
                found = shingles(words(piece.column("text")), width)
                some = np.flatnonzero(np.diff(found.docs))
                sig = signatures(found).reshape(-1, TREES, DEPTH)
                keys, sizes = [None] * len(piece), np.zeros(len(piece), np.int64)
                for row in some.tolist():
                    own = np.unique(found.hashes[found.docs[row] : found.docs[row + 1]])
                    keys[row], sizes[row] = hashlib.blake2b(own.tobytes(), digest_size=16).digest(), len(own)
                path = np.zeros(sig.shape[:2], np.uint64) + np.arange(TREES, dtype=np.uint64)
                for level in range(depth):
                    path = mix(path * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, level])
                rest = sig[:, :, depth:].astype(">u4").reshape(len(some), -1).view(np.uint8)
                low = (sig.reshape(len(some), -1) & 0xFF).astype(np.uint8)
                out = [[None] * len(piece) for _ in range(3)]
                for column, values in zip(out, (path.astype(np.int64).tolist(), _fixed(rest) if rest.size else [b""] * len(some), _fixed(low)), strict=True):
                    for row, value in zip(some.tolist(), values, strict=True):
                        column[row] = value
                columns = [
                    piece.column("doc_id"), piece.column("text_id"), pa.array(keys, pa.binary()), pa.array(sizes),
                    pa.array(out[0], pa.list_(pa.int64())), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_id", "key", "n", "paths", "rests", "low"])

    return rows.mapInArrow(sign, SIGNED.format(rows.schema["doc_id"].dataType.simpleString()))


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a symmetric matrix."""
    links, open_ = [], np.ones(len(near), bool)
    for root in range(len(near)):
        if not open_[root]:
            continue
        open_[root], waiting = False, [root]
        while waiting:
            at = waiting.pop()
            more = np.flatnonzero(near[at] & open_)
            open_[more] = False
            waiting.extend(more.tolist())
            links.extend((at, x) for x in more.tolist())
    return links


def descend(rests: np.ndarray, low: np.ndarray, side: np.ndarray, levels: int, most: int) -> list[tuple[int, int]]:
    """Links between rows of one trie node (sorted by ``rests``), deepest common prefixes first.

    Rows agree if at least ``most`` bytes of ``low`` do. Rows that hang together already are not compared
    again. ``side``: rows of one side are not compared, if there are two.
    """
    label, links = np.arange(len(low)), []
    apart = side.min() != side.max()
    for level in range(levels, -1, -1):
        prefix = rests[:, : 4 * level]
        cut = np.flatnonzero((prefix[1:] != prefix[:-1]).any(1)) + 1
        for begin, end in zip([0, *cut.tolist()], [*cut.tolist(), len(low)], strict=True):
            if end - begin < 2 or label[begin:end].min() == label[begin:end].max():
                continue
            for row in range(begin, end):
                other = begin + np.flatnonzero(label[begin:end] != label[row])
                if apart:
                    other = other[side[other] != side[row]]
                if not len(other):
                    continue
                agree = other[(low[other] == low[row]).sum(1) >= most]
                for x in agree.tolist():
                    if label[x] != label[row]:
                        links.append((row, x))
                        label[label == label[x]] = label[row]
    return links


def candidates(signs: DataFrame, threshold: float, depth: int) -> DataFrame:
    """Links between sets that share a prefix and whose signatures agree well enough."""
    spark = signs.sparkSession
    most = math.floor(TREES * DEPTH * (threshold - SLACK * math.sqrt(threshold * (1 - threshold) / (TREES * DEPTH))))
    step = 4 * (DEPTH - depth)
    places = signs.select(F.posexplode("paths").alias("tree", "path"), "key")
    sizes = places.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
    shared = places.join(sizes, "path")
    full = shared.join(signs.select("key", "rests", "low"), "key")
    full = full.withColumn("rest", F.expr(f"substring(rests, tree * {step} + 1, {step})")).drop("rests", "tree")
    dealt = halves(full, "key", "size", NODE)
    unit = ["path", "low_block", "high_block"]
    dealt = dealt.select(*unit, "mine", "rest", "key", "low")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, *unit).sortWithinPartitions(*unit, "rest", "key")

    def link(batches):
        for rows, starts in whole_groups(batches, *unit):
            keys = rows.column("key").to_pylist()
            low = np.frombuffer(b"".join(rows.column("low").to_pylist()), np.uint8).reshape(len(rows), -1)
            rest = np.frombuffer(b"".join(rows.column("rest").to_pylist()), np.uint8).reshape(len(rows), step)
            mine = rows.column("mine").to_numpy()
            found, begins, size = [], starts[:-1], np.diff(starts)
            two = begins[size == 2]
            close = (low[two] == low[two + 1]).sum(1) >= most
            found.extend(zip(two[close].tolist(), (two[close] + 1).tolist(), strict=True))
            for begin, n in zip(begins[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                own = slice(begin, begin + n)
                links = descend(rest[own], low[own], mine[own], DEPTH - depth, most)
                found.extend((begin + a, begin + b) for a, b in links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[pair[k]] for pair in found], pa.binary()) for k in (0, 1)], ["low", "high"]
            )

    return dealt.mapInArrow(link, "low binary, high binary")


def verify(sets: list[np.ndarray], side: np.ndarray, threshold: float, across: bool) -> np.ndarray:
    """Which pairs of sets have the Jaccard similarity; ``across``: pairs of two sides only, none if one is empty."""
    n = len(sets)
    if across and side.min() == side.max():
        return np.zeros((n, n), bool)
    sizes = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    every, which = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.flatnonzero(np.bincount(which, minlength=len(every)) > 1)
    number = np.full(len(every), -1)
    number[shared] = np.arange(len(shared))
    place = number[which]
    owner, place = owner[place >= 0], place[place >= 0]
    by = np.argsort(place, kind="stable")
    owner, place = owner[by], place[by]
    both, step = np.zeros((n, n), np.float32), 4096
    for begin in range(0, len(shared), step):
        low, high = np.searchsorted(place, [begin, begin + step])
        part = np.zeros((n, step), np.float32)
        part[owner[low:high], place[low:high] - begin] = 1
        both += part @ part.T
    least = threshold / (1 + threshold) * (sizes[:, None] + sizes)
    near = both >= least - 1e-6
    np.fill_diagonal(near, False)
    if across:
        near &= side[:, None] != side
    return near


def verified(documents: DataFrame, signs: DataFrame, groups: DataFrame, threshold: float, width: int) -> DataFrame:
    """Rows ``key, other, links``: how many links a set has in a task, or (``other``) one of a spanning forest."""
    spark = documents.sparkSession
    picked = groups.join(signs.select("key", "doc_id", "text_id", "n"), groups["id"] == signs["key"]).drop("id")
    size = F.sum(F.greatest("n", F.lit(LIGHT))).alias("size")
    picked = picked.join(picked.groupBy("component").agg(size), "component")
    picked = picked.select("key", "component", "size", F.col("doc_id").alias("own"), F.col("text_id").alias("own_text"))
    texts = documents.select(col("doc_id").alias("doc_id"), col("text").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.xxhash64("text") == F.col("own_text"))
    found = texts.join(picked, same).select("key", "component", "size", "text")

    def collect(batches):
        for batch in batches:
            for piece in slices(batch, lambda x: x.column("text")):
                own = shingles(words(piece.column("text")), width)
                sets = [np.unique(own.hashes[a:b]).tobytes() for a, b in zip(own.docs[:-1], own.docs[1:], strict=True)]
                columns = [piece.column(x) for x in ("key", "component", "size")] + [pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "component", "size", "set"])

    sets = found.mapInArrow(collect, "key binary, component binary, size long, set binary")
    sets = sets.groupBy("key", "component", "size").agg(F.first("set").alias("set"))  # repeated rows
    dealt = halves(sets, "key", "size", GROUP)
    unit = ["component", "low_block", "high_block"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select(*unit, "mine", "key", "set").repartition(parts, *unit).sortWithinPartitions(*unit, "key")

    def check(batches):
        for rows, starts in whole_groups(batches, *unit):
            keys, out = rows.column("key").to_pylist(), []
            mine = rows.column("mine").to_numpy()
            across = rows.column("low_block").to_numpy() != rows.column("high_block").to_numpy()
            data = [np.frombuffer(x, np.uint64) for x in rows.column("set").to_pylist()]
            for begin, end in zip(starts[:-1], starts[1:], strict=True):
                if end - begin < 2:
                    continue
                near = verify(data[begin:end], mine[begin:end], threshold, across[begin])
                counts = near.sum(1)
                out.extend((keys[begin + x], None, int(counts[x])) for x in np.flatnonzero(counts).tolist())
                out.extend((keys[begin + a], keys[begin + b], 0) for a, b in forest(near))
            kinds = (pa.binary(), pa.binary(), pa.int64())
            columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "other", "links"])

    return dealt.mapInArrow(check, "key binary, other binary, links long")


def classes(documents: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, width: int = WIDTH) -> DataFrame:
    """A row per document (repeated rows too): ``class_id``, the least doc_id of its class; ``class_rows``, the
    rows of the class; ``n_links``, how many different n-gram sets are similar to its own (its copies are
    not counted); ``first``, whether it is the class's first
    row; ``text_id``, the text's hash; ``wordless``.

    Two texts are linked if the Jaccard similarity of their sets is ``threshold`` or more; classes are what
    hangs together by links or equal sets. Texts without a word (null, empty) are each a class alone.
    """
    depth = least_depth(threshold, recall)
    rows, _ = kept(signed(documents, depth, width), "signed")
    first = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_id")
    wordy = rows.filter("key IS NOT NULL")
    signs = wordy.groupBy("key").agg(
        F.min(first).alias("first"),
        F.count("*").alias("rows"),
        *[F.first(x).alias(x) for x in ("n", "paths", "rests", "low")],
    )
    signs = signs.select("key", "first.doc_id", "first.text_id", "rows", "n", "paths", "rests", "low")
    signs, signs_at = kept(signs, "signs")
    groups, groups_at = components(candidates(signs, threshold, depth))
    checked, checked_at = kept(verified(documents, signs, groups, threshold, width), "verified")
    pairs = checked.filter("other IS NOT NULL").select(F.col("key").alias("low"), F.col("other").alias("high"))
    joined, _ = components(pairs)
    links = checked.groupBy("key").agg(F.sum("links").alias("n_links"))
    member = signs.select("key", "doc_id", "text_id", "rows").join(joined.withColumnRenamed("id", "key"), "key")
    whole = member.groupBy("component").agg(F.min(first).alias("first"), F.sum("rows").alias("class_rows"))
    linked = member.select("key", "component").join(whole, "component").join(links, "key")
    linked, _ = kept(linked.select("key", "first", "class_rows", "n_links"), "linked")
    alone = signs.select("key", first.alias("own"), "rows").join(linked, "key", "left")
    every = alone.select(
        "key",
        F.coalesce("first", "own").alias("first"),
        F.coalesce("class_rows", "rows").alias("class_rows"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    every, _ = kept(every, "classes")
    drop(signs, signs_at, groups_at, checked_at)
    out = rows.select(F.col("doc_id"), F.col("text_id"), "key").join(every, "key", "left")
    return out.select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("class_rows", F.lit(1)).cast("long").alias("class_rows"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("key").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_id") == F.col("first.text_id")))).alias("first"),
        "text_id",
        F.col("key").isNull().alias("wordless"),
    )


def keep_rows(documents: DataFrame, kept_rows: DataFrame) -> DataFrame:
    """The documents, with all their columns, that ``kept_rows`` names by ``doc_id`` and ``text_id``; of
    repeated rows that it names one stays, unless it says ``all_stay``."""
    names = [col(x) for x in documents.columns]
    rows = documents.select(F.struct(*names).alias("row"), col("doc_id").alias("doc_id"), F.xxhash64(col("text")).alias("text_id"))
    right = kept_rows.select(F.col("doc_id").alias("own"), F.col("text_id").alias("own_text"), "all_stay").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("text_id") == F.col("own_text"))
    found = rows.join(right, same)
    place = F.row_number().over(Window.partitionBy("doc_id", "text_id").orderBy(F.xxhash64("row")))
    return found.withColumn("place", place).filter("place = 1 OR all_stay").select("row.*")


def deduplicated(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class: the one with the least doc_id (then the least hash of its text). Every
    text without a word stays."""
    found = classes(documents, threshold).filter("first")
    return keep_rows(documents, found.select("doc_id", "text_id", F.col("wordless").alias("all_stay")))
