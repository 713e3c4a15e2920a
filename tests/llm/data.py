"""Documents with nulls, empty, long and repeated texts, and columns whose names operators use themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, `row` int, `key` string, score int, n_words int,"
    " size int, kept boolean, shard string, `bin` int, path string, `a.b` int, id int, low int, high int, listed int"
)
CLASHES = (1, "k", 2, 3, 4, False, "s", 5, "p", 6, 7, 8, 9, 10)

STORY = " ".join(f"word{n} then" for n in range(60))
LONG = " ".join(f"w{n % 977}x{n}" for n in range(60_000))
TEXTS = [
    (1, STORY, "en"),
    (1, STORY, "en"),
    (2, STORY + " end", "en"),
    (3, STORY.replace(" ", "\n"), "en"),
    (None, STORY, None),
    (4, None, "de"),
    (5, "", "de"),
    (6, " \n\t ", None),
    (7, LONG, "de"),
    (8, "1234 --- !!!", "de"),
    (None, None, None),
    (9, "ÄÖÜ straße über\nwenig\n\nwenig", "de"),
]


def documents(spark: SparkSession, texts=TEXTS) -> DataFrame:
    rows = [(i, t, lang, None if n % 3 else "src", len(t or ""), *CLASHES) for n, (i, t, lang) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def benchmark(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, "item_id long, text string, row int")


def labels(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
