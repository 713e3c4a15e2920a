"""Toxic passages: maximum-scoring segments over token log-odds.

Every word has a score: the lower confidence bound of its log-odds between toxic and clean labelled
documents under an informative Dirichlet prior, less a small drift that makes the mean score of clean
text negative. A scan in linear time finds all maximal segments of a text. Under the clean word
distribution their scores follow an extreme-value law with decay lambda, which gives each segment an
expected number of chance segments; the significant ones add up to the text's evidence, and a logistic
curve over that evidence, learned from the labels, to a score from 0 to 1.

Words are hashed to ``BUCKETS``; a word counts by itself and by its first bytes, so that forms
of one stem that were never seen score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.frames import col
from rowtide.llm.language import fold
from rowtide.llm.text import hash_spans, lowered, slices, spans, strings

BUCKETS = 1 << 20
STEM_BYTES = 5
#: About so many rows of each label are learned from, chosen by a hash of doc_id; all, if there are fewer.
FIT_ROWS = 20_000
#: Weight of the corpus-wide word shares in the prior, and of each bucket besides.
PRIOR, FLAT = 500.0, 0.5
#: Standard errors between a word's log-odds and the bound that counts.
MARGIN = 2.0
DRIFT = 0.05
FLOOR, CEILING = -12.0, 60.0
BINS = 144

PASSAGE = "struct<begin:int,end:int,score:double,chance:double>"


def features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each word and of its stem, and the bounds of the texts in them."""
    raw, at = strings(column)
    low = lowered(raw)
    start, end = spans(low, at)
    stem = np.minimum(start + STEM_BYTES, end)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    word = (hash_spans(low, start, end) >> shift).astype(np.int32)
    base = (hash_spans(low, start, stem) >> shift).astype(np.int32)
    return word, base, np.searchsorted(start, at)


def segments(values: list[float], at: list[int], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, by one pass over the words with a positive value.

    Word ``at[i]`` scores ``values[i] - drift``, every other word ``-drift``. Segments are kept with the
    sums before and after them; a new word joins the nearest earlier segment that began lower, for as
    long as that one ended lower too. Each segment keeps a link to its own nearest lower one, so that a search passes
    over all that began higher than one it has passed, and the time is linear in the words.
    """
    found: list[tuple] = []
    total, seen = 0.0, 0
    for value, place in zip(values, at, strict=True):
        total -= drift * (place - seen)
        before, total = total, total + value - drift
        seen = place + 1
        begin, low, back = place, before, len(found) - 1
        while True:
            while back >= 0 and found[back][2] >= low:
                back = found[back][4]
            if back < 0 or found[back][3] >= total:
                found.append((begin, seen, low, total, back))
                break
            begin, _, low, _, link = found[back]
            del found[back:]
            back = link
    return [(begin, end, high - low) for begin, end, low, high, _ in found]


@dataclass
class Model:
    """``scores`` per bucket (0: not above its drift), ``decay`` of the extreme-value law, the curve."""

    scores: np.ndarray
    drift: float
    decay: float
    slope: float = 1.0
    offset: float = 0.0

    def evidence(self, column) -> tuple[np.ndarray, list[list[dict]]]:
        """Evidence and significant passages of each text. Without a passage the evidence is least. It counts up to
        ``CEILING``, where the curve is 1 for all purposes: texts beyond it have the same score."""
        word, stem, docs = features(column)
        value = np.maximum(self.scores[word], self.scores[stem])
        places = np.flatnonzero(value)
        owner = np.searchsorted(docs, places, "right") - 1
        bounds = np.searchsorted(owner, np.arange(len(docs)))
        out, passages = np.full(len(docs) - 1, FLOOR), [[] for _ in range(len(docs) - 1)]
        for row in np.unique(owner).tolist():
            mine = places[bounds[row] : bounds[row + 1]]
            size = np.log(docs[row + 1] - docs[row])
            found = segments(value[mine].tolist(), (mine - docs[row]).tolist(), self.drift)
            bits = [(b, e, s, self.decay * s - size) for b, e, s in found]
            strong = [x for x in bits if x[3] > 0]
            out[row] = max(FLOOR, sum(x[3] for x in strong) or max((x[3] for x in bits), default=FLOOR))
            passages[row] = [dict(begin=b, end=e, score=s, chance=float(np.exp(-x))) for b, e, s, x in strong]
        return np.minimum(out, CEILING), passages


def _decay(scores: np.ndarray, drift: float, clean: np.ndarray) -> float:
    """The positive root of: mean over clean words of exp(decay * score) = 1."""
    some = scores > 0
    values, weights = scores[some] - drift, clean[some]
    rest = 1 - weights.sum()
    low, high = 0.0, 50.0
    for _ in range(80):
        middle = (low + high) / 2
        mean = rest * np.exp(-middle * drift) + (weights * np.exp(np.minimum(middle * values, 700))).sum()
        low, high = (middle, high) if mean < 1 else (low, middle)
    return max(low, 1e-3)


def _curve(evidence: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Logistic curve through binned counts, by Newton's method with a small ridge."""
    x = np.stack([evidence, np.ones_like(evidence)], 1)
    n, weight = toxic + clean, np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -35, 35)))
        step = x.T @ (toxic - n * p) - 0.01 * weight
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        change = np.linalg.solve(curve, step)
        weight = weight + np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-9:
            break
    return float(weight[0]), float(weight[1])


def _learnable(documents: DataFrame, labels: DataFrame, fit_rows: int) -> tuple[DataFrame, np.ndarray]:
    """All texts out of fold 0 of 5, a bounded sample of them with their labels (others null), and the share of
    the clean and of the toxic labels that is drawn. Of several labels the greatest holds."""
    known = labels.select(col("doc_id").alias("doc_id"), col("toxic").cast("int").alias("toxic"))
    known = known.filter(fold("doc_id", 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("toxic IN (0, 1)")
    counts = {x["toxic"]: x["n"] for x in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    shares = np.array([min(1.0, fit_rows / counts.get(k, 1)) for k in (0, 1)])
    share = F.when(F.col("toxic") == 1, float(shares[1])).otherwise(float(shares[0]))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) < share * (1 << 20)
    # About 2 * fit_rows pairs of numbers, whatever the input.
    sample = F.broadcast(known.filter(drawn))
    texts = documents.select(col("doc_id").alias("doc_id"), col("text").alias("text")).filter("text IS NOT NULL")
    learnable = texts.filter(fold("doc_id", 5) != 0)
    return learnable.join(sample, "doc_id", "left").select("text", "toxic"), shares


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn word scores, the extreme-value law and the curve from labelled documents.

    The prior's word shares are those of all documents. The curve weighs each class by 1 / its drawn share, so
    that a score means the same whether labels are sampled or not.
    """
    rows, shares = _learnable(documents, labels, fit_rows)

    def count(batches):
        sums = np.zeros((3, BUCKETS), np.int64)  # clean, toxic, all
        for batch in batches:
            for piece in slices(batch, lambda x: x.column("text")):
                word, stem, docs = features(piece.column("text"))
                toxic = pc.fill_null(piece.column("toxic"), 2).to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(len(toxic)), np.diff(docs))
                for found in (word, stem):
                    pair = np.unique(owner * BUCKETS + found)  # a text counts a word once
                    label, bucket = toxic[pair // BUCKETS], pair % BUCKETS
                    sums[2] += np.bincount(bucket, minlength=BUCKETS)
                    some = label < 2
                    np.add.at(sums.reshape(-1), label[some] * BUCKETS + bucket[some], 1)
        bucket = np.flatnonzero(sums.any(0)).astype(np.int32)
        columns = [pa.array(x) for x in (bucket, *sums[:, bucket])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *kinds])

    kinds = ("clean", "toxic", "every")
    parts = rows.mapInArrow(count, "bucket int, clean long, toxic long, every long")
    sums = parts.groupBy("bucket").agg(*[F.sum(x).alias(x) for x in kinds]).toArrow()
    counts = np.zeros((3, BUCKETS))
    counts[:, sums["bucket"].to_numpy()] = [sums[x].to_numpy() for x in kinds]
    counts, every = counts[:2], counts[2]
    if not counts.sum(1).all():
        return Model(np.zeros(BUCKETS), DRIFT, 1.0, 0.0, -1.0)
    prior = FLAT + PRIOR * every / every.sum()
    size = counts.sum(1) + prior.sum()
    odds = [np.log((counts[k] + prior) / (size[k] - counts[k] - prior)) for k in (0, 1)]
    error = np.sqrt((1 / (counts + prior)).sum(0))
    scores = np.maximum(odds[1] - odds[0] - MARGIN * error, 0.0)
    scores[counts[1] == 0] = 0.0
    clean = (counts[0] + FLAT) / (counts[0] + FLAT).sum()
    drift = max(DRIFT, 2 * float((clean * scores).sum()))
    scores[scores <= drift] = 0.0
    model = Model(scores, drift, _decay(scores, drift, clean))
    width = (CEILING - FLOOR) / BINS
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def bins(batches):
        for batch in batches:
            for piece in slices(batch, lambda x: x.column("text")):
                found, _ = sent.value.evidence(piece.column("text"))
                number = np.minimum((found - FLOOR) / width, BINS - 1).astype(np.int32)
                columns = [pa.array(number), piece.column("toxic")]
                yield pa.RecordBatch.from_arrays(columns, ["bin", "toxic"])

    table = rows.filter("toxic IS NOT NULL").mapInArrow(bins, "bin int, toxic int").groupBy("bin", "toxic").agg(F.count("*").alias("n")).toArrow()
    n = np.zeros((2, BINS))
    n[table["toxic"].to_numpy(), table["bin"].to_numpy()] = table["n"].to_numpy()
    clean_n, toxic_n = n / shares[:, None]
    model.slope, model.offset = _curve(FLOOR + (np.arange(BINS) + 0.5) * width, toxic_n, clean_n)
    return model


def scored(rows: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``rows`` has one column, ``row``, a struct that holds ``text``. Adds ``score`` and ``passages``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    schema = rows.withColumns({"score": F.lit(0.0), "passages": F.lit(None).cast(f"array<{PASSAGE}>")}).schema
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())]))

    def score(batches):
        model = sent.value

        def column(piece):
            return pc.struct_field(piece.column("row"), text)

        for batch in batches:
            for piece in slices(batch, column):
                evidence, passages = model.evidence(column(piece))
                scores = 1 / (1 + np.exp(-np.clip(model.slope * evidence + model.offset, -700, 700)))
                columns = [piece.column("row"), pa.array(scores, pa.float64()), pa.array(passages, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "score", "passages"])

    return rows.mapInArrow(score, schema)


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A score for every document (repeated rows too), learned from labels out of the held-out fold.

    ``held_out`` are documents of fold 0 of 5. A document without an id is neither held out nor learned
    from. Null and empty texts have no passage, like clean ones. If a label is missing altogether,
    every score is the same and below a half.
    """
    model = fit(documents, labels)
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    rows = documents.select(F.struct(col("doc_id").alias("doc_id"), held, col("text").alias("text")).alias("row"))
    found = scored(rows, model)
    return found.select(
        "row.doc_id", "row.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages"
    )


def clean(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are not predicted toxic."""
    model = fit(documents, labels)
    rows = documents.select(F.struct(*[col(name) for name in documents.columns]).alias("row"))
    return scored(rows, model).filter("score < 0.5").select("row.*")
