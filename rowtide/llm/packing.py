"""Best-fit packing of token sequences into bins of several permitted lengths.

Texts are cut into pieces of at most the greatest length. Pieces are dealt to shards of about
``SHARD`` pieces by a hash, so shards do not grow with the input, and each is packed by itself:

* Pieces go, longest first, to the open bin that they leave the least room in.
* If none has room, a bin is opened. Which length it gets is a choice: for each permitted length the shard
  is packed once with bins no shorter than that (a longer one only where a piece needs it).
* Bins are downsized to the shortest permitted length that holds their contents, and the packing of least
  cost is taken, so the lengths are chosen jointly by what they cost in the end.

A bin of n tokens costs ``n + n * n / quadratic + overhead``: long bins cost more a token (attention), short
ones too (their fixed part). The length of a text is its number of words between blanks, or any
column of token numbers.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.frames import col, kept

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD, QUADRATIC = 16, 1 << 16
SHARD = 50_000
#: Most pieces that a task packs at once: repeated rows can make a shard larger than meant.
MOST = 4 * SHARD


def words_long(text: str) -> Column:
    """Number of stretches without a blank; null has none."""
    return F.regexp_count(F.coalesce(col(text), F.lit("")), F.lit(r"\S+"))


def best_fit(sizes: list[int], lengths: tuple[int, ...], least: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and place in it of each of ``sizes`` (longest first), and the room used in each bin; new bins are
    of the shortest permitted length of at least ``least`` that holds the piece."""
    rooms: list[int] = []
    waiting: dict[int, list[int]] = {}
    used: list[int] = []
    where, start = [], []
    for size in sizes:
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            bins = waiting[room]
            number = bins.pop()
            if not bins:
                del waiting[room]
                del rooms[at]
        else:
            number = len(used)
            room = lengths[bisect_left(lengths, max(size, least))]
            used.append(0)
        where.append(number)
        start.append(used[number])
        used[number] += size
        if room > size:
            if room - size not in waiting:
                rooms.insert(bisect_left(rooms, room - size), room - size)
                waiting[room - size] = []
            waiting[room - size].append(number)
    return where, start, used


def price(length: int, overhead: int, quadratic: int) -> float:
    return length + length * length / quadratic + overhead


def pack(sizes: list[int], lengths: tuple[int, ...], overhead: int, quadratic: int) -> tuple[list[int], list[int], list[int]]:
    """The packing of least cost: bin and place of each piece, and the length of each bin."""
    best = None
    for least in lengths:
        where, start, used = best_fit(sizes, lengths, least)
        fitted = [lengths[bisect_left(lengths, x)] for x in used]
        cost = sum(price(x, overhead, quadratic) for x in fitted)
        if best is None or cost < best[0]:
            best = cost, where, start, fitted
    return best[1:] if best else ([], [], [])


def pieces(documents: DataFrame, tokens: Column, most: int) -> DataFrame:
    """``doc_id, text_id, piece`` (from 0), ``first`` (token) and ``tokens`` of each piece of each text."""
    rows = documents.select(col("doc_id").alias("doc_id"), F.xxhash64(col("text")).alias("text_id"), tokens.cast("long").alias("n"))
    rows = rows.filter("n > 0")
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most))))
    first = F.col("piece") * most
    return cut.select("doc_id", "text_id", "piece", first.alias("first"), F.least(F.lit(most), F.col("n") - first).alias("tokens"))


def packed(
    documents: DataFrame,
    tokens: Column | None = None,
    lengths: tuple[int, ...] = LENGTHS,
    overhead: int = OVERHEAD,
    quadratic: int = QUADRATIC,
    shard: int = SHARD,
) -> DataFrame:
    """A row per piece: ``doc_id, piece, first, tokens, bin, start`` (in the bin) and ``bin_length``.

    Documents without a token (null, empty) have no piece. Repeated rows are packed each. ``bin`` names the
    shard and the bin in it. Pieces of one length are taken in the order of doc_id, text hash and piece.
    """
    lengths = tuple(sorted(set(lengths)))
    spark = documents.sparkSession
    rows, _ = kept(pieces(documents, words_long("text") if tokens is None else tokens, lengths[-1]), "pieces")
    shards = max(1, -(-rows.count() // shard))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_id", "piece"), F.lit(shards)))
    parts = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("shard"), F.col("tokens").desc(), F.col("doc_id"), F.col("text_id"), F.col("piece")]
    dealt = dealt.repartition(parts, "shard").sortWithinPartitions(*order)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece long, first long, tokens long, bin string, start long, bin_length long"

    def bins(batches):
        for part, rows in _portions(batches):
            sizes = rows.column("tokens").to_pylist()
            where, start, fitted = pack(sizes, lengths, overhead, quadratic)
            label = f"{rows.column('shard')[0].as_py()}-{part}-"
            columns = [rows.column(x).combine_chunks() for x in ("doc_id", "piece", "first", "tokens")]
            columns += [pa.array([label + str(x) for x in where], pa.string()), pa.array(start, pa.int64())]
            columns.append(pa.array([fitted[x] for x in where], pa.int64()))
            names = ["doc_id", "piece", "first", "tokens", "bin", "start", "bin_length"]
            yield from pa.Table.from_arrays(columns, names).to_batches(max_chunksize=10_000)

    return dealt.mapInArrow(bins, schema)


def _portions(batches):
    """Rows of each shard, ``MOST`` at most at a time, and the number of the portion."""
    rest, part = None, 0

    def out(rows):
        nonlocal part
        for low in range(0, len(rows), MOST):
            yield part, rows.slice(low, MOST)
            part += 1

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if not len(rows):
            continue
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        shard = rows.column("shard").to_numpy()
        cut = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist()]
        for low, high in zip(cut, cut[1:], strict=False):
            yield from out(rows.slice(low, high - low))
            part = 0
        rest = rows.slice(cut[-1])
        if len(rest) >= MOST:
            yield from out(rest.slice(0, MOST))
            rest = rest.slice(MOST)
        if not len(rest):
            rest = None
    if rest is not None:
        yield from out(rest)
