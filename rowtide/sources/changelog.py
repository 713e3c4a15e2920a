"""The change log that row triggers fill, and the record of what has been sent from it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.sources.batches import Batches

OLDEST_FIRST = ["changed_at", "change_id"]
#: Microseconds of a day.
DAY = 86_400_000_000
#: Ids in a block (fixed by Spark's functions), and in a word of its bitmap.
BLOCK, WORD = 32_768, 64


class SentLog:
    """Which changes have reached the topic, as bitmaps; the log itself is never updated.

    A bitmap is of one day of changes and of one block of ids, kept as those of its words that have a bit set: a change
    costs a few bits where ids are given in order, and never more than a word of its own. Each mark adds bitmaps; ``close`` folds those of finished days into one for each block and sets them aside, and from
    then on neither they nor the days' part of the log are read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.marks = Batches(spark, path, MARKS_SCHEMA)
        self.folded = Batches(spark, path, MARKS_SCHEMA, "folded")
        self.closings = Batches(spark, path, "day long", "closed")

    def closed(self) -> int | None:
        """The first day that is not closed; none if no day is."""
        last = max(self.closings.numbers(), default=0)
        return self.closings.read_one(last).first()["day"] if last else None

    def read(self) -> DataFrame:
        """The marks of open days."""
        closed, marks = self.closed(), self.marks.read()
        return marks if closed is None else marks.filter(F.col("day").isNull() | (F.col("day") >= closed))

    def read_all(self) -> DataFrame:
        return self.marks.read().unionByName(self.folded.read())

    def mark(self, sent: DataFrame) -> int:
        return self.marks.write(marks_of(sent))

    def close(self, before: int) -> None:
        """Close the days before ``before`` (a day number). Marks may be there twice if this is broken off, which
        changes nothing, and none is dropped before it is written again."""
        old = self.marks.numbers()
        marks = merged(self.marks.read()).sortWithinPartitions("day")
        self.folded.write(marks.filter(F.col("day") < before))
        self.closings.write(self.marks.spark.range(1).select(F.lit(before).cast("long").alias("day")))
        self.marks.write(marks.filter(F.col("day").isNull() | (F.col("day") >= before)))
        self.marks.drop(old)


#: ``bits`` is a whole bitmap, as stores have it that were written before bitmaps were kept by words.
MARKS_SCHEMA = "day long, block long, words array<struct<word: int, bits: bigint>>, bits binary"
_PLACE = ("day", "block", "word")


def marks_of(changes: DataFrame) -> DataFrame:
    """Bitmaps of the ids of changes, for each day and block of ids. Tasks send words of bitmaps, not ids."""
    return _by_block(_words_of(changes))


def merged(marks: DataFrame) -> DataFrame:
    return _by_block(_words(marks))


def marked_ids(marks: DataFrame) -> DataFrame:
    """``change_id`` and ``day`` of every bit that is set, for ids above 0."""
    place = F.col("word") * WORD + F.col("bit")
    each = _merged_words(_words(marks)).select("*", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1))).alias("bit"))
    each = each.filter(_is_set(F.col("bits"), place))
    return each.select(((F.col("block") - 1) * BLOCK + place + 1).alias("change_id"), "day")


def _bit(place: Column) -> Column:
    """The word with the bit of a place set. Bits count from the low end of each byte and bytes from the high end of the
    word, as in Spark's bitmaps."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % WORD).cast("int").bitwiseXOR(F.lit(WORD - 8)))


def _is_set(bits: Column, place: Column) -> Column:
    return bits.bitwiseAND(_bit(place)) != 0


def _word(place: Column) -> Column:
    return F.floor(place / WORD).cast("int")


def _words_of(changes: DataFrame) -> DataFrame:
    """One word with one bit for each change that has an id."""
    placed = changes.select(day(F.col("changed_at")).alias("day"), F.col("change_id").cast("long").alias("id"))
    place = F.bitmap_bit_position("id")
    block = F.bitmap_bucket_number("id").alias("block")
    return placed.filter("id IS NOT NULL").select("day", block, _word(place).alias("word"), _bit(place).alias("bits"))


def _words(marks: DataFrame) -> DataFrame:
    """The words of bitmaps, a row each."""
    words = F.col("words")
    if "bits" in marks.columns:
        taken = lambda n: F.conv(F.hex(F.substring(F.col("bits"), n * (WORD // 8) + 1, F.lit(WORD // 8))), 16, -10)
        each = lambda n: F.struct(n.alias("word"), taken(n).cast("long").alias("bits"))
        whole = F.transform(F.sequence(F.lit(0), F.lit(BLOCK // WORD - 1)), each)
        words = F.coalesce(words, F.filter(whole, lambda x: x["bits"] != 0))
    return marks.select("day", "block", F.inline(words))


def _merged_words(words: DataFrame) -> DataFrame:
    return words.groupBy(*_PLACE).agg(F.bit_or("bits").alias("bits"))


def _by_block(words: DataFrame) -> DataFrame:
    return _merged_words(words).groupBy("day", "block").agg(F.collect_list(F.struct("word", "bits")).alias("words"))


def day(at: Column) -> Column:
    """Days since 1970 in UTC, whatever the session's zone."""
    micros = F.unix_micros(at.cast("timestamp"))
    return ((micros - F.pmod(micros, F.lit(DAY))) / DAY).cast("long")


def _day_start(number: int, changelog: DataFrame) -> Column:
    return F.timestamp_micros(F.lit(number * DAY)).cast(changelog.schema["changed_at"].dataType)


def since(changelog: DataFrame, closed: int | None) -> DataFrame:
    """The log without closed days; the filter reaches its scan. Changes without a time stay."""
    at = F.col("changed_at")
    return changelog if closed is None else changelog.filter(at.isNull() | (at >= _day_start(closed, changelog)))


def in_open_days(changelog: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The log and the marks of the days that have waiting changes.

    A day is finished if every waiting change in the log has its bit in the marks; a change that commits late opens its day
    again, however old, unless the day is closed. That takes one pass over ids and days, which sends words of bitmaps. One row per
    day comes to the driver, and the filters made of them reach both scans. Changes without a
    time are always compared.
    """
    at = F.col("changed_at")
    waiting = _words_of(changelog.filter(~F.col("processed"))).withColumn("sent", F.lit(None).cast("long"))
    both = waiting.unionByName(_words(marks).withColumn("sent", F.col("bits")))
    words = both.groupBy(*_PLACE).agg(F.bit_or("bits").alias("bits"), F.coalesce(F.bit_or("sent"), F.lit(0)).alias("sent"))
    open_ = F.col("day").isNotNull() & (F.col("bits") != F.col("sent"))
    found = [r["day"] for r in words.filter(open_).select("day").distinct().collect()]
    if not found:
        return changelog.filter(at.isNull()), marks.filter("day IS NULL")
    # Two filters, as a source takes only the one without a computed day.
    bounds = [_day_start(x, changelog) for x in (min(found), max(found) + 1)]
    near = changelog.filter(at.isNull() | ((at >= bounds[0]) & (at < bounds[1])))
    near = near.filter(at.isNull() | day(at).isin(found))
    return near, marks.filter(F.col("day").isNull() | F.col("day").isin(found))


def captured(changelog: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Only the changes of the chosen tables."""
    return changelog.filter(F.col("table_name").isin(*tables))


def _with_sent(changelog: DataFrame, sent: DataFrame) -> DataFrame:
    """The log with ``_sent``; ``sent`` holds marks, or plain ids as ``change_id``."""
    if "words" not in sent.columns:
        done = sent.select("change_id").distinct().withColumn("_done", F.lit(True))
        joined = changelog.join(done, "change_id", "left")
        return joined.select(*changelog.columns, F.col("_done").isNotNull().alias("_sent"))
    marks = _merged_words(_words(sent)).select(*[F.col(c).alias(f"_{c}") for c in (*_PLACE, "bits")])
    id_ = F.col("change_id").cast("long")
    place = F.bitmap_bit_position(id_)
    same = day(F.col("changed_at")).eqNullSafe(F.col("_day")) & (F.bitmap_bucket_number(id_) == F.col("_block"))
    found = F.coalesce(_is_set(F.col("_bits"), place), F.lit(False)).alias("_sent")
    return changelog.join(marks, same & (_word(place) == F.col("_word")), "left").select(*changelog.columns, found)


def with_processed(changelog: DataFrame, sent: DataFrame) -> DataFrame:
    """Bring the ``processed`` flag up to date with what has been sent."""
    return _with_sent(changelog, sent).select(
        *[c for c in changelog.columns if c != "processed"], (F.col("processed") | F.col("_sent")).alias("processed")
    )


def pending(
    changelog: DataFrame,
    sent: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Changes not sent yet, however old: all of them, or the oldest ``limit``."""
    waiting = changelog.filter(~F.col("processed"))
    if sent is not None:
        waiting = _with_sent(waiting, sent).filter("NOT _sent").drop("_sent")
    return waiting if limit is None else waiting.orderBy(*OLDEST_FIRST).limit(limit)


def missed(changelog: DataFrame, sent: SentLog) -> DataFrame:
    """Changes of closed days that were never sent: they committed after their day was closed. A full pass over
    the closed days, to be asked now and then."""
    closed = sent.closed()
    if closed is None:
        return changelog.limit(0)
    return pending(changelog.filter(F.col("changed_at") < _day_start(closed, changelog)), sent.read_all())


def purge_before(changelog: DataFrame, sent: DataFrame, before: Column) -> DataFrame:
    """The log without changes that were sent and are older than ``before``."""
    flagged = with_processed(changelog, sent)
    return flagged.filter(~(F.col("processed") & (F.col("changed_at") < before)))
