"""URL filter: rules on hosts and paths, then a Bloom filter cascade, in DataFrame functions only.

The cascade knows the whole universe of keys. Its first level is a Bloom filter of the listed keys. The keys
of the universe that it takes for listed are written to the second level, the listed keys that this one takes
for those to the third, and so on until a level errs on nothing: the first level that does not hold a key
decides, and does so exactly for every key of the universe. No row is joined: the levels are arrays of
numbers, of at most ``MOST_BITS`` bits each, that come as scalar subqueries. More listed keys than that are
dealt to segments by a hash, each with a cascade of its own, which are sent one after the other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.frames import col, drop, kept

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Share of keys that a level after the first may err on.
ERROR = 1 / 32
#: Bits of a level: 8 MB.
MOST_BITS = 1 << 26
#: Segments whose levels one plan holds.
AT_ONCE = 4


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z as a-z; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(rules: list[Rule], host: Column, path: Column) -> Column:
    """Name and verdict of the longest rule that fits the host or a parent domain of it, and the path's start."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda x: (len(x.name), x.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def _places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    """The bits of a key, by ``hashes`` hashes."""
    own = F.xxhash64(F.lit(level), key)
    return [F.pmod(F.xxhash64(F.lit(n), own, key), F.lit(bits)) for n in range(hashes)]


@dataclass
class Level:
    table: DataFrame
    bits: int
    hashes: int

    def holds(self, key: Column, number: int) -> Column:
        words = self.table.scalar()
        out = F.lit(True)
        for place in _places(key, number, self.bits, self.hashes):
            word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
            out = out & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return out


def _level(keys: DataFrame, count: int, error: float, number: int) -> Level:
    """A Bloom filter of ``keys``: one row, an array of 64-bit words."""
    hashes = max(1, round(math.log2(1 / error)))
    bits = min(MOST_BITS, 64 * max(1, math.ceil(count * hashes / math.log(2) / 64)))
    place = F.explode(F.array(*_places(F.col("key"), number, bits, hashes)))
    marked = keys.select(place.alias("place")).select(
        F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("mask")
    )
    words = marked.groupBy("word").agg(F.bit_or("mask").alias("mask"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    dense = words.unionAll(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "mask")))  # at most MOST_BITS / 64 numbers
    table, _ = kept(dense.agg(F.transform(ordered, lambda x: x["mask"]).alias("words")), "level")
    return Level(table, bits, hashes)


def cascade(universe: DataFrame) -> list[Level]:
    """Levels for the columns ``key`` (each once) and ``listed``."""
    levels: list[Level] = []
    inside, outside = universe.filter("listed").select("key"), universe.filter("NOT listed").select("key")
    paths: list[str] = []
    n, rest = inside.count(), outside.count()
    while n:
        first = min(0.5, max(ERROR / 1024, n / max(1, rest))) if not levels else ERROR
        level = _level(inside, n, first, len(levels))
        levels.append(level)
        wrong, path = kept(outside.filter(level.holds(F.col("key"), len(levels) - 1)), "wrong")
        inside, outside, paths = wrong, inside, [*paths, path]
        n = wrong.count()
    drop(universe, *paths)
    return levels


def contains(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: it is if an odd number of levels holds it in a row."""
    out = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels) - 1, -1, -1):
        out = F.when(levels[number].holds(key, number), out).otherwise(F.lit(number % 2 == 1))
    return out


def listed(rows: DataFrame, universe: DataFrame, key: str) -> DataFrame:
    """The rows with a column ``listed``: whether the universe lists their ``key``. Every key of the rows must be
    in the universe; of several rows of a key in it one that lists it is enough."""
    universe, path = kept(universe.groupBy("key").agg(F.max("listed").alias("listed")), "universe")
    n = universe.filter("listed").count()
    segments = max(1, math.ceil(n * 20 / MOST_BITS))
    part = F.pmod(F.xxhash64(F.lit("segment"), "key"), F.lit(segments))
    rows = rows.withColumn("listed", F.lit(False))
    for number in range(segments):
        levels = cascade(universe.filter(part == number))
        mine = F.pmod(F.xxhash64(F.lit("segment"), F.col(key)), F.lit(segments)) == number
        rows = rows.withColumn("listed", F.when(mine, contains(levels, F.col(key))).otherwise(F.col("listed")))
        if number % AT_ONCE == AT_ONCE - 1:
            rows, _ = kept(rows, "judged")
    drop(rows, path)
    return rows


def judged(pages: DataFrame, rules: list[Rule], blocked: Column, url: str = "url") -> DataFrame:
    """A row per page (repeated rows too): ``page_id, host, path, rule, verdict``.

    The key of a page is its host and path. ``blocked`` says which pages put their key on the block list. Pages
    that no rule fits are blocked if their key is listed. Null urls and urls without ``://`` have the empty key.
    """
    rows = pages.select(
        col("page_id").alias("page_id"), host_of(col(url)).alias("host"), path_of(col(url)).alias("path"), blocked.alias("listed")
    )
    key = F.concat("host", F.lit(" "), "path")
    universe = rows.select(key.alias("key"), F.coalesce("listed", F.lit(False)).alias("listed"))
    found = listed(rows.drop("listed").withColumn("key", key), universe, "key")
    found = found.withColumn("ruled", ruled(rules, F.col("host"), F.col("path")))
    own = F.when(F.col("listed"), "block").otherwise("allow")
    verdict = F.coalesce("ruled.verdict", own).alias("verdict")
    return found.select("page_id", "host", "path", F.col("ruled.rule").alias("rule"), verdict)
