"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams per language come from a bounded sample of labelled rows, in one pass whose partial
counts Spark adds up; they become a matrix of log probabilities (languages x buckets) that is sent to
the tasks. A batch of texts is scored as a sparse matrix: ``docs`` are the row bounds, the hashed
n-grams the column numbers, all entries one. Whole texts are scored; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.frames import col
from rowtide.llm.text import mix, slices, strings

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: About so many rows of a language are learned from, chosen by a hash of doc_id; all, if it has fewer.
FIT_ROWS = 20_000
#: Most cells of the matrix that is sent to the tasks: 256 MB. More than 512 languages have fewer buckets each.
MOST_CELLS = 1 << 25
#: Languages that are learned: those with the most rows, if ``lang`` has more values than this.
MOST_LANGUAGES = 1 << 15
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a blank."""
    out = np.full(0x110000, 32, np.int32)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            out[code] = ord(low) if len(low := letter.lower()) == 1 else code
    return out


def code_points(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the text bounds in them."""
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    padded = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.int32)
    first, tail = padded[lead], [padded[lead + k] & 0x3F for k in (1, 2, 3)]
    two = (first & 0x1F) << 6 | tail[0]
    three = (first & 0x0F) << 12 | tail[0] << 6 | tail[1]
    four = (first & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
    codes = np.where(first < 0x80, first, np.where(first < 0xE0, two, np.where(first < 0xF0, three, four)))
    return np.minimum(codes, 0x10FFFF), np.searchsorted(lead, at)


def grams(column, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the bounds of each text in them, and whether it has a letter.

    Letters count in lower case, every run of other characters as one blank. An n-gram that crosses
    the bounds of its text has the bucket number ``buckets``.
    """
    codes, at = code_points(*strings(column))
    codes = _letters()[codes]
    blank = codes == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    counts = np.concatenate([[0], np.cumsum(~blank)])
    lettered = counts[at[1:]] > counts[at[:-1]]
    at = np.concatenate([[0], np.cumsum(keep)])[at]
    codes = np.insert(codes[keep], at[:-1], 0)
    at = at + np.arange(len(at))
    padded = np.concatenate([codes, np.zeros(max(ORDERS), np.int32)]).astype(np.uint64)
    rolled, edge, out = np.zeros(len(codes), np.uint64), np.zeros(len(codes), bool), []
    for order in range(1, max(ORDERS) + 1):
        after = padded[order - 1 : order - 1 + len(codes)]
        rolled = rolled * np.uint64(0x100000001B3) + after + np.uint64(order)
        edge |= after == 0
        if order in ORDERS:
            bucket = (mix(rolled) >> np.uint64(40)).astype(np.int32) % buckets
            bucket[edge] = buckets
            out.append(bucket)
    return np.stack(out, 1).ravel(), at * len(ORDERS), lettered


@dataclass
class Model:
    """``matrix[i, b]``: log probability of bucket b in language i; ``prior``: log share of its rows."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray
    buckets: int

    def predict(self, column) -> tuple[list[str], np.ndarray]:
        found, at, lettered = grams(column, self.buckets)
        if not self.languages or not len(found):
            return [UNKNOWN] * (len(at) - 1), np.zeros(len(at) - 1)
        total = np.stack([np.add.reduceat(row[found], at[:-1]) for row in self.matrix], 1) + self.prior
        best = total.argmax(1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        names = [self.languages[x] if ok else UNKNOWN for x, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, score, 0.0)


def fit(rows: DataFrame, buckets: int = BUCKETS, fit_rows: int = FIT_ROWS, smoothing: float = 0.5) -> Model:
    """Learn from the columns ``doc_id``, ``text`` and ``lang``; rows without text or language teach nothing.

    The matrix stays within ``MOST_CELLS`` at any number of languages, as the buckets get fewer. Of more than
    ``MOST_LANGUAGES`` values those with the most rows are learned, of equal ones the first by name.
    """
    spark = rows.sparkSession
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    counted = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    counts = {x["lang"]: x["n"] for x in counted.collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, buckets + 1)), buckets)
    buckets = min(buckets, MOST_CELLS // len(languages))
    learned = [(x, n, min(1.0, fit_rows / counts[x])) for n, x in enumerate(languages)]
    learned = F.broadcast(spark.createDataFrame(learned, "lang string, which int, share double"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) < F.col("share") * (1 << 20)

    def count(batches):
        sums = np.zeros((len(languages), buckets), np.int64)
        for batch in batches:
            for piece in slices(batch, lambda x: x.column("text")):
                found, at, _ = grams(piece.column("text"), buckets)
                lang = np.repeat(piece.column("which").to_numpy().astype(np.int64), np.diff(at))
                inside = found < buckets
                np.add.at(sums.reshape(-1), lang[inside] * buckets + found[inside], 1)
        which, bucket = np.nonzero(sums)
        columns = [pa.array(x) for x in (which.astype(np.int32), bucket.astype(np.int32), sums[which, bucket])]
        yield pa.RecordBatch.from_arrays(columns, ["which", "bucket", "n"])

    parts = rows.join(learned, "lang").filter(drawn).select("text", "which").mapInArrow(count, "which int, bucket int, n long")
    sums = parts.groupBy("which", "bucket").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.full((len(languages), buckets), smoothing)
    matrix[sums["which"].to_numpy(), sums["bucket"].to_numpy()] += sums["n"].to_numpy()
    matrix = np.log(matrix / matrix.sum(1, keepdims=True))
    prior = np.log(np.array([counts[x] for x in languages]) / sum(counts.values()))
    return Model(languages, prior, np.pad(matrix, ((0, 0), (0, 1))), buckets)


def predict(rows: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows in a struct ``row``, with ``lang_pred`` and ``score``. Null text and text without a letter
    are ``und`` with score 0; so is everything if the model has learned nothing."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    packed = rows.select(F.struct(*[col(x) for x in rows.columns if x != text]).alias("row"), col(text).alias("text"))
    schema = packed.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def score(batches):
        for batch in batches:
            for piece in slices(batch, lambda x: x.column("text")):
                names, scores = sent.value.predict(piece.column("text"))
                columns = [piece.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "lang_pred", "score"])

    return packed.mapInArrow(score, schema)


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(col(doc_id).cast("string").cast("binary")) % folds


def identified(documents: DataFrame) -> DataFrame:
    """The language of every document (repeated rows too), learned from the rows out of the held-out fold.

    ``held_out`` are documents of fold 2 of 4. A document without an id is neither held out nor learned from.
    """
    rows = documents.select(col("doc_id").alias("doc_id"), col("text").alias("text"), col("lang").alias("lang"))
    model = fit(rows.filter(fold("doc_id", 4) != 2))
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    found = predict(rows.select("doc_id", held, "text"), model)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")
