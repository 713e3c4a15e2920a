"""What a job could not apply: the records with their reasons, and how many records it read of each kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowtide.sources.batches import Batches

REJECTED = ("no_key", "unknown_op")
#: Every record is of one kind: usable, or set aside for one of these reasons.
KINDS = ("accepted", *REJECTED, "tombstone")

REJECTS_SCHEMA = "kafka_timestamp timestamp, partition int, offset long, key string, message string, reject string"


class Rejects:
    """Rejected records under ``rejects=N``, the counts of each run under ``counts=N``, both by the number of the
    run. A run that is repeated replaces its own, so nothing is counted twice."""

    def __init__(self, spark: SparkSession, path: str):
        self.records = Batches(spark, path, REJECTS_SCHEMA, "rejects")
        self.tallies = Batches(spark, path, "kind string, n long", "counts")

    def read(self) -> DataFrame:
        return self.records.read()

    def counts(self) -> DataFrame:
        """Records of each kind over all runs that are kept."""
        return self.tallies.read().groupBy("kind").agg(F.sum("n").alias("n"))

    def save(self, rejected: DataFrame, counted: dict[str, int], number: int) -> None:
        """Keep a run. ``rejected`` is computed only if the counts say that there is something in it."""
        if any(counted[x] for x in REJECTED):
            self.records.write(rejected, number)
        rows = [(kind, counted[kind]) for kind in KINDS]
        self.tallies.write(self.tallies.spark.createDataFrame(rows, self.tallies.schema).coalesce(1), number)

    def forget(self, before: int) -> None:
        """Delete the runs before ``before``, which a later one has read again."""
        for kept in (self.records, self.tallies):
            kept.drop([n for n in kept.numbers() if n < before])


class Tally:
    """Counts the kinds of parsed records in the pass that computes them for something else."""

    def __init__(self) -> None:
        self.observed = Observation()

    def over(self, parsed: DataFrame) -> DataFrame:
        """``parsed``, counted while it is computed. Attach it to one query only."""
        kind = F.coalesce("reject", F.lit("accepted"))
        return parsed.observe(self.observed, *[F.count_if(kind == x).alias(x) for x in KINDS])

    def counts(self) -> dict[str, int]:
        """The counts, once the query has run. Records of a stage that ran again after an executor was lost may be
        counted again; what is stored is not."""
        found = self.observed.get
        return {x: found.get(x, 0) for x in KINDS}
