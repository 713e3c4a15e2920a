"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from rowtide.llm import (
    decontamination,
    exact,
    language,
    licences,
    lines,
    ngram_join,
    packing,
    sharding,
    toxicity,
    url_filter,
)
from rowtide.llm.queries import RULES
from tests.llm.data import LONG, STORY, TEXTS, benchmark, documents, labels


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, []).cache()


def items_of(spark, rows=((7, " ".join(STORY.split()[:20]), 1), (None, "wenig", 1), (8, None, 1), (9, "", 1))):
    return benchmark(spark, list(rows))


def all_labels(spark):
    return labels(spark, [(n, 1, n % 2) for n in range(12)] + [(None, 1, 1), (3, None, None)])


REPORTS = {
    "op1": lambda s, d: decontamination.report(d, items_of(s)),
    "op2": lambda s, d: language.identified(d),
    "op4": lambda s, d: packing.packed(d, lengths=(512, 1024)).select("doc_id").distinct(),
    "op5": lambda s, d: licences.scanned(d, F.col("doc_id") == 9),
    "op6": lambda s, d: ngram_join.classes(d),
    "op7": lambda s, d: toxicity.report(d, all_labels(s)),
    "op8": lambda s, d: exact.report(d),
    "op9": lambda s, d: sharding.sharded(d),
}


@pytest.mark.parametrize("name", [x for x in REPORTS if x != "op4"])
def test_a_row_for_each_document(spark, docs, none, name):
    assert REPORTS[name](spark, docs).count() == len(TEXTS)
    assert REPORTS[name](spark, none).count() == 0


FILTERS = {
    "op1": lambda s, d: decontamination.decontaminated(d, items_of(s)),
    "op3": lambda s, d: lines.deduplicated(d),
    "op6": lambda s, d: ngram_join.deduplicated(d),
    "op7": lambda s, d: toxicity.clean(d, all_labels(s)),
    "op8": lambda s, d: exact.deduplicated(d),
}


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_all_columns(spark, docs, none, name):
    for given in (docs, none):
        left = FILTERS[name](spark, given)
        assert [(x.name, x.dataType) for x in left.schema] == [(x.name, x.dataType) for x in given.schema]
        assert left.count() <= given.count()


def test_exact_keeps_one_of_repeated_rows(spark, docs):
    got = exact.report(docs)
    assert got.filter("kept").count() == exact.deduplicated(docs).count() == got.select("text_sha256").distinct().count()
    story = got.filter("doc_id = 1").collect()
    assert [x.kept for x in story].count(True) <= 1
    assert {x.group_size for x in story} == {4}  # twice doc 1, doc 3, and the one without an id
    assert {x.group_size for x in got.filter("doc_id IN (4, 5, 6)").collect()} == {4}  # null counts as empty


def test_near_copies(spark, docs):
    got = {(x.doc_id, x.wordless): x for x in ngram_join.classes(docs).collect()}
    assert got[2, False].class_id == got[1, False].class_id == got[3, False].class_id == 1
    assert got[1, False].class_rows == 5 and got[1, False].n_links == 1
    assert got[7, False].class_rows == 1 and got[4, True].class_rows == 1
    left = [x.doc_id for x in ngram_join.deduplicated(docs).collect()]
    assert sorted(left, key=str) == sorted([1, 4, 5, 6, 7, 8, None, 9], key=str)


def test_decontamination_without_items(spark, docs):
    got = decontamination.report(docs, items_of(spark, [])).collect()
    assert all(x.n_hit == 0 and x.n_items == 0 and not x.contaminated for x in got)
    long = next(x for x in got if x.doc_id == 7)
    assert long.n_words == len(LONG.split())


def test_short_items_and_items_without_id(spark, docs):
    got = {x.doc_id: x for x in decontamination.report(docs, items_of(spark)).filter("doc_id IS NOT NULL").collect()}
    assert got[9].n_hit == 2 and got[9].items == [""]
    assert got[1].n_hit == 20 and got[1].items == ["7"] and got[1].contaminated
    assert got[4].n_words == 0 and not got[4].contaminated


def test_benchmark_in_many_blocks(spark, docs, monkeypatch):
    whole = decontamination.report(docs, items_of(spark)).collect()
    monkeypatch.setattr(decontamination.blocks, "__defaults__", (32,))
    cut = decontamination.report(docs, items_of(spark)).collect()
    assert sorted(whole, key=str) == sorted(cut, key=str)


def test_undetermined_language(spark, docs):
    got = {x.doc_id: x for x in language.identified(docs).filter("doc_id IS NOT NULL").collect()}
    assert {n for n in got if got[n].lang_pred == "und"} >= {4, 5, 6, 8}
    assert all(0 <= x.score <= 1 for x in got.values())


def test_one_label_missing(spark, docs):
    got = toxicity.report(docs, labels(spark, [(1, 1, 0), (2, 1, 0)])).collect()
    assert {x.predicted for x in got} == {0} and len({x.score for x in got}) == 1


def test_lines_without_words_stay(spark, docs):
    left = {x.doc_id: x.text for x in lines.deduplicated(docs).filter("doc_id IN (4, 5, 6, 9)").collect()}
    assert left == {4: None, 5: "", 6: " \n\t ", 9: "ÄÖÜ straße über\nwenig\n"}


def test_null_urls(spark):
    rows = [(1, None, "x"), (2, "no scheme", None), (3, "http://A.Example.COM/en/x?y", "x"), (None, "s://h#f", "x" * 2000), (3, "x://a.net/es/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit(1))
    got = {(x.host, x.path): (x.rule, x.verdict) for x in url_filter.judged(pages, RULES, F.length("html") < 1000).collect()}
    assert got == {
        ("", ""): (None, "block"),
        ("a.example.com", "/en/x"): ("example.com/en/", "block"),
        ("h", ""): (None, "allow"),
        ("a.net", "/es/"): ("net/es/", "block"),
    }
    assert url_filter.judged(pages.limit(0), RULES, F.lit(True)).count() == 0


def test_toxicity_scores_do_not_depend_on_the_sample(spark):
    """Labels that say nothing of the text: every score is the share of toxic labels, sampled or not."""
    rows = [(n, " ".join(f"w{(n * 7 + k) % 50}" for k in range(12)), "en") for n in range(2000)]
    every = documents(spark, rows)
    known = labels(spark, [(n, 1, int(n // 50 % 10 == 3)) for n in range(2000)])
    for fit_rows in (10_000, 150):
        model = toxicity.fit(every, known, fit_rows)
        got = toxicity.scored(every.selectExpr("struct(doc_id, text) AS row"), model).agg(F.avg("score"), F.max("score")).first()
        assert abs(got[0] - 0.1) < 0.03 and got[1] < 0.5
