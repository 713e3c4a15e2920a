"""Fingerprints of documents by winnowing, in DataFrame functions only.

Every ``K`` consecutive code points are hashed; of every ``WINDOW`` consecutive hashes the least is kept, the
rightmost of equal ones, with its place. So two texts that share ``WINDOW + K - 1`` code points in a row share a
kept hash. A text with fewer than ``K`` code points is one gram, one with fewer than ``WINDOW`` grams one window.

A hash and its place are compared as one number: the hash, turned round, in the high half, the place in the low one,
so that the greatest number is the least hash and, of equal hashes, the rightmost. Minima of all windows come by
doubling their width. What a window keeps depends on its own characters alone; so the fingerprint of a text that is
put together from two others is theirs, but for the windows across the seam.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.frames import col, drop, kept
from rowtide.session import pinned

#: Code points of a gram, and grams of a window.
K, WINDOW = 16, 64
#: Code points of a window.
SPAN = WINDOW + K - 1
#: Windows that are worked on at a time, in one text.
STRETCH = 1024
#: Bytes of a code point in the form that texts are cut in. A gram's place is the number, from 1, of its first byte.
WIDE = 4
LOW = (1 << 32) - 1


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _byte(number: Column) -> Column:
    return number.bitwiseAND(F.lit(LOW))


def _number(raw: Column, byte: Column) -> Column:
    gram = F.xxhash64(F.substring(raw, byte, F.lit(WIDE * K)))
    return gram.bitwiseAND(F.lit(~LOW)).bitwiseOR(byte.cast("long"))


def _greatest(numbers: Column) -> Column:
    """The greatest of the ``WINDOW`` numbers from each place on; past the end there are fewer."""

    def widened(numbers: Column, width: int) -> Column:
        if width == WINDOW:
            return numbers
        step = min(width, WINDOW - width)
        more = F.transform(numbers, lambda v, i: F.greatest(v, F.get(numbers, i + step)))
        return let(more, lambda x: widened(x, width + step))

    return widened(numbers, 1)


def _stretch(raw: Column, first: Column, end: Column) -> Column:
    """Numbers kept by the windows that begin in a stretch; its grams begin at the bytes ``first`` to ``end``."""

    def of(numbers: Column) -> Column:
        windows = F.greatest(F.size(numbers) - (WINDOW - 1), F.lit(1))
        return F.array_distinct(F.slice(_greatest(numbers), F.lit(1), windows))

    return let(F.transform(F.sequence(first, end, F.lit(WIDE)), lambda x: _number(raw, x)), of)


def winnowed(text: Column) -> Column:
    """Numbers that are kept of a text that is not null, in order of their places."""

    def of(raw: Column, end: Column) -> Column:
        # The last stretch has a window at least; two stretches may keep the same number at their border.
        starts = F.sequence(F.lit(1), F.greatest(end - WIDE * (WINDOW - 1), F.lit(1)), F.lit(WIDE * STRETCH))
        most = WIDE * (STRETCH + WINDOW - 2)
        every = F.transform(starts, lambda first: let(F.least(end, first + most), lambda x: _stretch(raw, first, x)))
        return F.when(end > 0, F.array_distinct(F.flatten(every))).otherwise(F.array().cast("array<bigint>"))

    # The last gram's first byte: 1 if the text is shorter than a gram, none if it is empty.
    end = lambda raw: F.greatest(F.length(raw) - WIDE * K + 1, F.least(F.length(raw), F.lit(1)))
    return let(F.encode(text, "UTF-32"), lambda raw: let(end(raw), lambda x: of(raw, x)))


def _moved(numbers: Column, chars: Column) -> Column:
    return F.transform(numbers, lambda y: y + WIDE * chars.cast("long"))


def _begun(numbers: Column, chars: Column) -> Column:
    """What is kept of the first ``chars`` code points by whole windows, given the numbers kept of the whole text.

    A window is the first to keep a number either because the number before has left it, or because a greater one
    has entered it.
    """

    last = (WIDE * (chars - SPAN) + 1).cast("long")

    def of(numbers: Column) -> Column:
        def window(y: Column, i: Column) -> Column:
            before = F.get(numbers, i - 1)
            return F.when(i == 0, 1).when(y > before, _byte(y) - WIDE * (WINDOW - 1)).otherwise(_byte(before) + WIDE)

        return F.slice(numbers, F.lit(1), F.size(F.filter(F.transform(numbers, window), lambda x: x <= last)))

    return let(numbers, of)


def joined(left: Column, left_numbers: Column, n_left: Column, right: Column, right_numbers: Column, n_right: Column) -> Column:
    """Numbers kept of the text ``left`` and ``right`` together, the first ``n_left`` and ``n_right`` code points of
    two texts with these numbers; only the windows across the seam are worked out."""
    tail, head = F.least(n_left, F.lit(SPAN - 1)), F.least(n_right, F.lit(SPAN - 1))
    seam = F.concat(F.substring(left, n_left - tail + 1, tail), F.substring(right, F.lit(1), head))
    crossed = (tail + head >= SPAN) | ((tail == n_left) & (head == n_right))
    across = F.when(crossed, _moved(winnowed(seam), n_left - tail)).otherwise(F.array().cast("array<bigint>"))
    return F.array_distinct(F.concat(_begun(left_numbers, n_left), across, _moved(_begun(right_numbers, n_right), n_left)))


def hashes(numbers: Column) -> Column:
    return F.transform(numbers, lambda y: F.shiftrightunsigned(F.bitwise_not(y), 32))


def fingerprint(numbers: Column) -> Column:
    """``place:hash`` of each kept gram, by a blank; places are code points from 0, hashes eight hex digits."""
    place = lambda y: F.shiftright(_byte(y) - 1, 2).cast("string")
    name = lambda y: F.lpad(F.hex(F.shiftrightunsigned(F.bitwise_not(y), 32)), 8, "0")
    return F.array_join(F.transform(numbers, lambda y: F.concat(place(y), F.lit(":"), name(y))), " ")


def likeness(one: Column, other: Column) -> Column:
    """Kept hashes in both, as a share of those in either; 1 if neither text has any."""
    every = F.size(F.array_union(one, other))
    return F.when(every == 0, 1.0).otherwise(F.size(F.array_intersect(one, other)) / every)


def _texts(documents: DataFrame) -> DataFrame:
    """Documents with their key: the id (a null one is set apart) and the text's hash."""
    rows = documents.select(
        col("doc_id").cast("long").alias("doc_id"), F.coalesce(col("text"), F.lit("")).alias("text")
    )
    key = [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("h")]
    return rows.select(*key, "text")


KEY = ["no_id", "id", "h"]


def _next(documents: DataFrame) -> tuple[DataFrame, str]:
    """For the key of each text, the key, size and number of copies of the text before it, and the table's path.

    Texts are ordered by id (null first), those of one id by hash; rows alike in both are copies. The one before the
    first is the last. Ids are sorted by range and looked up inside each range, then at the ranges' borders.
    """
    order = [F.desc("no_id"), F.asc("id"), F.asc("h")]
    size = F.length("text").alias("n")
    slim = _texts(documents).select(*KEY, size).groupBy(*KEY).agg(F.min("n").alias("n"), F.count("*").alias("copies"))
    spread = slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged, path = kept(spread, "ranged")
    own = F.struct(*KEY, "n", "copies")
    inside = Window.partitionBy("part").orderBy(*order)
    linked = ranged.select(*KEY, "part", F.lag(own).over(inside).alias("before"))
    last = ranged.groupBy("part").agg(F.max_by(own, F.struct(~F.col("no_id"), "id", "h")).alias("last"))
    # One row for each range.
    ends = sorted(pinned(last).collect(), key=lambda x: x["part"])
    borders = [(x["part"], ends[n - 1]["last"]) for n, x in enumerate(ends)]
    schema = F.broadcast(documents.sparkSession.createDataFrame(borders, last.withColumnRenamed("last", "border").schema))
    linked = linked.join(schema, "part").select(*KEY, F.coalesce("before", "border").alias("before"))
    out = kept(linked, "next")
    drop(documents, path)
    return out


def fingerprinted(documents: DataFrame) -> DataFrame:
    """A row per document (repeated rows too): ``doc_id, n_chars, edited, numbers, edited_numbers, near_edited,
    near_next``.

    ``edited`` is the text with its last half (of an odd number of code points the lesser one) replaced by as many code
    points, or all, of the next document's text, in order of ``doc_id`` (null first; rows of one id by the hash of
    their text). Null text is empty. The next of a repeated row is its copy, but for one of them. Texts are shuffled once, with their numbers; of each text its beginning, as much as the
    document before takes of it, and its numbers once more.
    """
    before, _ = _next(documents)
    texts = _texts(documents).withColumn("numbers", winnowed(F.col("text")))
    # Repeated rows become one before they are shuffled.
    texts = texts.groupBy(*KEY).agg(F.first("text").alias("text"), F.first("numbers").alias("numbers"))
    half = F.floor(F.col("before.n") / 2).cast("int")
    after = texts.join(before, KEY).select(
        *[F.col(f"before.{x}").alias(x) for x in (*KEY, "copies")],
        F.substring("text", F.lit(1), half).alias("next_text"),
        F.col("numbers").alias("next_numbers"),
    )
    rows = texts.join(after, KEY)
    n = F.length("text")
    rest = F.floor(n / 2).cast("int")
    self_ = F.struct(F.substring("text", F.lit(1), rest).alias("text"), F.col("numbers").alias("numbers"))
    other = F.struct(F.col("next_text").alias("text"), F.col("next_numbers").alias("numbers"))
    nexts = F.when(F.col("copies") > 1, F.concat(F.array(other), F.array_repeat(self_, (F.col("copies") - 1).cast("int"))))
    rows = rows.withColumn("next", F.explode(F.coalesce(nexts, F.array(other))))
    rows = rows.select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), n.cast("long").alias("n_chars"), "text", "numbers", "next",
        (n - rest).alias("n_left"), F.length("next.text").alias("n_right"),
    )
    edited = joined(*[F.col(x) for x in ("text", "numbers", "n_left", "next.text", "next.numbers", "n_right")])
    rows = rows.withColumn("edited_numbers", edited).withColumn("own", hashes(F.col("numbers")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.concat(F.substring("text", F.lit(1), F.col("n_left")), "next.text").alias("edited"),
        "numbers",
        "edited_numbers",
        likeness(F.col("own"), hashes(F.col("edited_numbers"))).alias("near_edited"),
        likeness(F.col("own"), hashes(F.col("next.numbers"))).alias("near_next"),
    )
