"""Licence scan: sparse TF-IDF cosine of lines to templates, then inheritance down the directories.

Every line of every file is compared, as a header may stand anywhere; only DataFrame functions are used.

1. Inverse line frequencies of the templates' terms are counted over all lines; a term of no template weighs
   as one that never occurs.
2. A line can only reach the threshold if it has one of the few terms that a template cannot do without
   (see ``needed``). Lines without one are left out by this bound, exactly.
3. Distinct lines that are left are split into terms and joined with the templates' terms: cosine.
4. A file's own licence is that of its best line. The best of the licence files in a directory holds for the
   directory; a file without its own takes that of its nearest ancestor directory that has one.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.frames import col, kept
from rowtide.llm.url_filter import LOWER, UPPER

THRESHOLD = 0.7
DIGITS = 6
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Usual header lines of public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def terms(text: str) -> list[str]:
    return [x for x in re.split(BREAK, text.translate(str.maketrans(UPPER, LOWER))) if x]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), BREAK), "")


def weigh(counts: dict[str, int], lines: int, templates) -> list[tuple[str, int, str, float]]:
    """``licence, template, term, weight`` with weights so that a template has length 1."""
    out = []
    for number, (name, text) in enumerate(templates):
        tf = Counter(terms(text))
        weights = {x: n * idf(counts.get(x, 0), lines) for x, n in tf.items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        out.extend((name, number, x, w / length) for x, w in sorted(weights.items()))
    return out


def idf(count: int, lines: int) -> float:
    return math.log((1 + lines) / (1 + count)) + 1


def needed(weights: list[tuple[str, int, str, float]], threshold: float) -> list[str]:
    """Terms such that a line without any is below the threshold for every template: the other terms of a
    template have a length of less than the threshold together."""
    out: set[str] = set()
    for number in {x[1] for x in weights}:
        left = 0.0
        for weight, term in sorted((w, t) for _, n, t, w in weights if n == number):
            left += weight * weight
            if math.sqrt(left) >= threshold - 1e-9:
                out.add(term)
    return sorted(out)


def _lines(files: DataFrame) -> DataFrame:
    """``file`` (a struct of path and text hash) and each of its lines, as words."""
    cut = F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1))
    return files.select("file", cut.alias("line"))


def matches(lines: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``file``, ``licence`` and ``cosine`` (rounded) of each line that reaches the threshold with a template; of
    several templates the best, then the last by name."""
    spark = lines.sparkSession
    vocabulary = sorted({x for _, text in templates for x in terms(text)})
    known = F.array(*[F.lit(x) for x in vocabulary])
    seen = lines.select(F.explode(F.array_append(F.array_intersect(words(F.col("line")), known), F.lit(""))).alias("term"))
    counts = {x["term"]: x["n"] for x in seen.groupBy("term").agg(F.count("*").alias("n")).collect()}
    n = counts.pop("", 0)
    weights = weigh(counts, n, templates)
    must = needed(weights, threshold)
    # A cheap test of the bytes first, then of the words.
    some = F.col("line").rlike("(?i)" + "|".join(re.escape(x) for x in must)) if must else F.lit(False)
    close = lines.filter(some).withColumn("words", words(F.col("line"))).filter(
        F.arrays_overlap("words", F.array(*[F.lit(x) for x in must]))
    )
    close, _ = kept(close.select("file", F.concat_ws(" ", "words").alias("line")), "licence_lines")
    tf = close.select("line").distinct().select("line", F.explode(F.split("line", " ")).alias("term"))
    tf = tf.groupBy("line", "term").agg(F.count("*").alias("tf"))
    rare = idf(0, n)
    scale = spark.createDataFrame([(x, idf(counts.get(x, 0), n)) for x in vocabulary], "term string, idf double")
    weighed = tf.join(F.broadcast(scale), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(rare)))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("line"))).alias("length")
    weighed = weighed.select("line", "term", "w", length)
    table = spark.createDataFrame(weights, "licence string, template int, term string, weight double")
    dot = weighed.join(F.broadcast(table), "term").groupBy("line", "licence", "template")
    cosine = F.round(F.sum(F.col("w") * F.col("weight")) / F.first("length"), DIGITS)
    best = dot.agg(cosine.alias("cosine")).filter(F.col("cosine") >= threshold)
    best = best.groupBy("line").agg(F.max(F.struct("cosine", "licence")).alias("best"))
    return close.join(best, "line").select("file", "best.licence", "best.cosine")


def scanned(files: DataFrame, licence_file: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """A row per file (repeated rows too): ``doc_id, path, own`` (licence of its best line), ``cosine``, ``licence``
    (its own, or inherited) and ``origin`` (the directory it is from; null for its own or none).

    ``files`` has ``doc_id``, ``path`` (parts joined by ``/``) and ``text``; ``licence_file`` is a condition on its
    columns. Null or empty texts have no licence of their own; a null path is the empty one, whose directory is
    the root that all share.
    """
    path = F.coalesce(col("path"), F.lit(""))
    rows = files.select(
        col("doc_id").alias("doc_id"), path.alias("path"), licence_file.alias("speaks"), col("text").alias("text"),
    ).withColumn("file", F.struct("path", F.xxhash64("text").alias("text_id")))
    found = matches(_lines(rows), templates, threshold)
    best = found.groupBy("file").agg(F.max(F.struct("cosine", "licence")).alias("best"))
    best, _ = kept(best.select("file", F.col("best.licence").alias("own"), F.col("best.cosine").alias("cosine")), "own")
    parts = F.split("path", "/")
    folder = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    every = rows.select("doc_id", "path", "speaks", "file", folder.alias("folder")).join(best, "file", "left")
    every, _ = kept(every.drop("file"), "files")
    speaking = every.filter("speaks AND own IS NOT NULL").groupBy("folder").agg(F.max(F.struct("cosine", "own")).alias("best"))
    speaking = speaking.select(F.col("folder").alias("above"), F.col("best.own").alias("given"))
    folders = every.filter("own IS NULL").select("folder").distinct()
    up = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(up)), lambda n: F.array_join(F.slice(up, 1, n), "/"))
    ladder = folders.select("folder", F.posexplode(above).alias("depth", "above")).join(speaking, "above")
    nearest = ladder.groupBy("folder").agg(F.max(F.struct("depth", "given", "above")).alias("nearest"))
    out = every.join(nearest, "folder", "left")
    mine = F.col("own").isNotNull()
    return out.select(
        "doc_id", "path", "own", "cosine",
        F.when(mine, F.col("own")).otherwise(F.col("nearest.given")).alias("licence"),
        F.when(~mine, F.col("nearest.above")).alias("origin"),
    )
