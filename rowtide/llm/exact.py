"""Exact deduplication by progressive refinement, in DataFrame functions only.

Texts are compared without the characters space, \\t, \\n, \\v, \\f and \\r. Candidates are narrowed step by
step: rows whose normalised text has a length that others have too; of these, rows with the same hash of
the first ``PREFIX`` characters; only of those is the whole text read again and hashed. Null counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.frames import col, drop, kept

PREFIX = 256
DROPPED = " \t\n\x0b\f\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), DROPPED, "")


def _rows(documents: DataFrame) -> DataFrame:
    """What the steps group by; a row keeps the first characters only as a hash."""
    text = normalised(F.col("text"))
    return documents.select(
        col("doc_id").alias("doc_id"), col("text").alias("text")
    ).select(
        "doc_id",
        F.xxhash64("text").alias("text_id"),
        F.length(F.coalesce("text", F.lit(""))).alias("n_chars"),
        F.length(text).alias("size"),
        F.xxhash64(F.substring(text, 1, PREFIX)).alias("prefix"),
        text.alias("normal"),
    )


def _survivors(documents: DataFrame) -> tuple[DataFrame, list[str]]:
    """``doc_id, text_id, n_chars, sha`` of the rows that share length and prefix with others, and the paths of the
    tables that this reads."""
    rows = _rows(documents)
    # Read back, the few lengths need no shuffle of the rows, and a length that many rows have no task of its own.
    sizes, sizes_at = kept(rows.groupBy("size").agg(F.count("*").alias("n")).filter("n > 1").select("size"), "sizes")
    alike = rows.join(sizes, "size", "left_semi").groupBy("size", "prefix").agg(F.count("*").alias("n"))
    alike, alike_at = kept(alike.filter("n > 1").select("size", "prefix"), "alike")
    full = rows.join(alike, ["size", "prefix"], "left_semi")
    full = full.select("doc_id", "text_id", "n_chars", F.sha2(F.col("normal").cast("binary"), 256).alias("sha"))
    return full, [sizes_at, alike_at]


def _grouped(full: DataFrame) -> DataFrame:
    # The most code points, then the least doc_id (null last), then the least text hash.
    first = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_id").alias("text"))
    found = full.groupBy("sha").agg(F.count("*").alias("group_size"), F.min(first).alias("first")).filter("group_size > 1")
    return found.select("sha", F.col("first.id").alias("keep_id"), F.col("first.text").alias("keep_text"), "group_size")


def groups(documents: DataFrame) -> tuple[DataFrame, str]:
    """``sha, keep_id, keep_text, group_size`` of texts that occur more than once, and the table's path."""
    full, paths = _survivors(documents)
    out = kept(_grouped(full), "groups")
    drop(documents, *paths)
    return out


def report(documents: DataFrame) -> DataFrame:
    """A row per document, dropped ones too: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points stays, then the one with the least doc_id (null last);
    of rows that are alike in this too, one.
    """
    found, _ = groups(documents)
    sha = F.sha2(F.col("normal").cast("binary"), 256).alias("sha")
    rows = _rows(documents).select("doc_id", "text_id", sha).join(found, "sha", "left")
    alone = F.col("group_size").isNull()
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_id") == F.col("keep_text"))
    rows = rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | first).alias("first"),
        "text_id",
        F.col("sha").alias("text_sha256"),
    )
    # Repeated rows of one doc_id and text: one of them stays.
    place = F.row_number().over(Window.partitionBy("doc_id", "text_id").orderBy("first"))
    rows = rows.withColumn("kept", F.col("first") & (place == 1))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents, with all their columns, that stay.

    Only survivors of length and prefix are hashed whole. Of them the ids that go are found, and the documents are read
    once more without these; no text is shuffled as long as the ids are few enough for Spark to broadcast. Of
    repeated rows of the id and text that stay, one does.
    """
    full, paths = _survivors(documents)
    full, full_at = kept(full, "survivors")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_id") == F.col("keep_text"))
    members = full.join(_grouped(full), "sha").select("doc_id", "text_id", first.alias("stays"))
    named = members.groupBy("doc_id", "text_id").agg(F.count("*").alias("n"), F.max("stays").alias("stays"))
    named = named.filter("NOT stays OR n > 1").select(F.col("doc_id").alias("own"), F.col("text_id").alias("own_text"), "stays")
    named, _ = kept(named, "named")
    drop(documents, *paths, full_at)
    names = [col(x) for x in documents.columns]
    rows = documents.select(F.struct(*names).alias("row"), col("doc_id").alias("doc_id"), F.xxhash64(col("text")).alias("text_id"))
    same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("text_id") == F.col("own_text"))
    out = rows.join(named, same, "left_anti").select("row")
    if not named.filter("stays").isEmpty():
        place = F.row_number().over(Window.partitionBy("doc_id", "text_id").orderBy(F.xxhash64("row")))
        repeated = rows.join(named.filter("stays"), same, "left_semi").withColumn("place", place)
        out = out.unionAll(repeated.filter("place = 1").select("row"))
    return out.select("row.*")
