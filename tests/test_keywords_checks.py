"""X1-X5."""

import re

import pytest
from pyspark.sql import functions as F

import docketry as d
from docketry.operators import keywords
from helpers import optimized, plan, rows

TAXONOMY = {
    "First": {"relevant": True, "keywords": ["deal", "spin-off", "Deal", "credit agreement"]},
    "Second": {"relevant": False, "keywords": ["agreement", "deal", "-x", "c++"]},
    "Other": {"relevant": False, "keywords": []},
}
TEXTS = ["A DEAL.", "spin-off", "spinoff deals", "the credit agreement", "credit  agreement", "déal ideal", "a -x", "a-x", "-x",
         "c++", "C++.", "c+++", "deal\ndeal", "", "_deal_", "1deal", "deal1 deal", "deal spin-off", "ágreement agreement"]


@pytest.fixture(scope="module")
def taxonomy(spark):
    return d.taxonomy_from_dict(spark, TAXONOMY)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "n int, text string")


def edges(keyword, text):
    """A whole word by the letter: ends of text or a character that is no letter or digit."""
    for found in re.finditer(f"(?={re.escape(keyword)})", text):
        before, after = text[:found.start()][-1:], text[found.start() + len(keyword):][:1]
        if not before.isalnum() and not after.isalnum():
            return True
    return False


def test_hits_against_a_plain_reading(texts, taxonomy):
    want = sorted(
        (n, label, hits) for n, text in enumerate(TEXTS) for label, entry in TAXONOMY.items()
        if (hits := sum(edges(k, text.lower()) for k in {k.lower() for k in entry["keywords"]})))
    assert sorted(rows(d.keyword_hits(texts, taxonomy, "n"))) == want


def test_classify(texts, taxonomy):
    got = {r[0]: r[1:] for r in rows(d.keyword_classify(texts, taxonomy).select("n", "event_type", "relevant", "hits"))}
    assert got[TEXTS.index("A DEAL.")] == ("First", True, 1)
    assert got[TEXTS.index("c++")] == ("Second", False, 1)
    assert got[TEXTS.index("deal spin-off")] == ("First", True, 2)
    assert got[TEXTS.index("")] == ("Other", False, 0)


def test_large_taxonomies_are_joined_with_equal_results(spark, texts, taxonomy, monkeypatch):
    small_hits = sorted(rows(d.keyword_hits(texts, taxonomy, "n")))
    small = sorted(rows(d.keyword_classify(texts, taxonomy)))
    monkeypatch.setattr(keywords, "MOST_CONSTANTS", 3)
    joined = d.keyword_hits(texts, taxonomy, "n")
    assert sorted(rows(joined)) == small_hits
    assert sorted(rows(d.keyword_classify(texts, taxonomy, key="n"))) == small
    text = plan(joined)
    assert "HashJoin" in text or "SortMergeJoin" in text
    assert "Cartesian" not in text and "NestedLoop" not in text
    with pytest.raises(ValueError):
        d.keyword_classify(texts, taxonomy)
    monkeypatch.undo()
    many = d.taxonomy_from_dict(spark, {f"Label {n}": {"keywords": [f"word{n}", f"two words{n}"]} for n in range(2_000)} | {"Other": {}})
    df = spark.createDataFrame([(1, "some word7, and TWO words7; word8"), (2, "sword7 word"), (3, None)], "n int, text string")
    assert rows(d.keyword_hits(df, many, "n"), "event_type") == [(1, "Label 7", 2), (1, "Label 8", 1)]
    assert rows(d.keyword_classify(df, many, key="n").select("n", "event_type", "hits"), "n") == [(1, "Label 7", 2), (2, "Other", 0), (3, None, None)]


def test_no_pattern_comes_from_a_row(spark, texts, taxonomy):
    text = optimized(d.keyword_hits(texts, taxonomy, "n"))
    assert "lambda" not in text.split("RLIKE")[0] or "RLIKE(__lowered" in text
    for found in re.findall(r"RLIKE\(([^,]+), ([^)]*)", text):
        assert "#" not in found[1]


def test_without_fallback_label(spark, texts):
    bare = d.taxonomy_from_dict(spark, {"Only": {"keywords": ["zzz"]}})
    assert {r[:] for r in rows(d.keyword_classify(texts, bare).select("event_type", "hits"))} == {(None, 0)}
    nothing = spark.createDataFrame([(None,)], "text string")
    assert rows(d.keyword_classify(nothing, bare).select("event_type", "hits")) == [(None, None)]


def test_evidence_needs_no_join(spark, taxonomy, data):
    documents = spark.read.parquet(f"{data}/documents.parquet")
    text = plan(d.keyword_classify(documents.select("doc_id", "text"), taxonomy).filter("event_type = 'First'"))
    assert "Join" not in text and "EvalPython" not in text and "Exchange hash" not in text


def test_consensus(spark, taxonomy):
    votes = spark.createDataFrame(
        [(1, "Second"), (1, "First"), (1, "Second"), (1, "Other"), (2, "Second"), (2, "First"), (3, None), (4, "zz"), (4, "aa")],
        "n int, event_type string")
    assert rows(d.strategy_consensus(votes, taxonomy, "n"), "n") == [
        (1, "Second", 4, 0.5), (2, "First", 2, 0.5), (4, "aa", 2, 0.5)]


def test_consensus_counts_before_the_shuffle(spark, taxonomy):
    hot = spark.range(30000).select(F.expr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END").alias("n"),
                                    F.expr("CASE WHEN id % 2 = 0 THEN 'First' ELSE 'Other' END").alias("event_type"))
    out = d.strategy_consensus(hot, taxonomy, "n")
    assert rows(out.filter("n = 0")) == [(0, "First", 10000, 0.5)]
    assert "Window" not in plan(out) and "collect_" not in plan(out)


@pytest.mark.parametrize(
    "response, status, issues",
    [("REASONING:\nfine\n\nVALIDATION:\nStatus: VALID\nIssues: none", "VALID", None),
     ("Status: INVALID\nIssues: wrong  label\nand flag ", "INVALID", "wrong label and flag"),
     ("**Status:** [invalid]\n**Issues:** x", "INVALID", "x"), ("status: valid", "VALID", None),
     ("Status: INVALID\nIssues:  ", "INVALID", None), ("Status: unsure", None, None), ("", None, None), (None, None, None)],
)
def test_validation(spark, response, status, issues):
    df = spark.createDataFrame([(response,)], "response string")
    assert rows(d.parse_validation(df).select("validation_status", "issues")) == [(status, issues)]


def test_schema_violations(spark, taxonomy):
    df = spark.createDataFrame(
        [("a", "First", 0.5, True), (None, "First", 0.5, True), ("b", None, 0.5, True), ("c", "Nope", 0.5, True),
         ("d", "Other", 1.2, True), ("e", "Other", None, True), ("f", "Other", float("nan"), True), ("g", "Other", 0.0, None)],
        "accession_number string, event_type string, confidence double, relevant boolean")
    got = rows(d.schema_violations(df, taxonomy).select("accession_number", "violation"), "accession_number")
    assert got == [(None, "missing_key"), ("b", "missing_label"), ("c", "unknown_label"), ("d", "bad_confidence"),
                   ("e", "bad_confidence"), ("f", "bad_confidence"), ("g", "missing_relevance")]
