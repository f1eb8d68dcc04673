"""What keeps work and memory in proportion to the input."""

import os
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql.types import LongType, StringType, StructField, StructType

import docketry as d
from docketry.llm import ngram_join
from docketry.operators import keywords
from docketry.operators.batches import PIECE_BYTES
from docketry.operators.extraction import raw_text
from docketry.operators.scoring import scorer
from docketry.sinks.manifest import Manifests
from docketry.sinks.tables import CLASSIFICATIONS, load_parts
from docketry.streaming.arrivals import _Arrivals
from helpers import rows
from workload.queries import land_files, page_of_path


class Seen(dict):
    """A map of state that counts how often it is asked."""

    asked = 0

    def containsKey(self, key):
        self.asked += 1
        return key in self

    def updateValue(self, key, value):
        self[key] = value


def test_a_call_marks_all_keys_of_a_bucket():
    schema = StructType([StructField("cik", StringType()), StructField("n", LongType())])
    arrivals = _Arrivals(["cik", "n"], schema, 1000)
    arrivals.seen = Seen()
    part = pd.DataFrame({"cik": ["a", "a", "b", "a"], "n": [1, 1, 1, 2]})
    marks = [list(p["arrival"]) for p in arrivals.handleInputRows((7,), iter([part, part]), None)]
    assert marks == [["first", "repeat", "first", "first"], ["repeat"] * 4]
    assert arrivals.seen.asked == 6 and set(arrivals.seen) == {("a", 1), ("b", 1), ("a", 2)}


def test_landed_files_share_folders(spark, tmp_path):
    pages = spark.createDataFrame([(n, f"page {n}ä") for n in range(300)] + [(300, None), (301, "a"), (301, "b")], "page_id long, html string")
    land_files(pages.coalesce(1), f"file://{tmp_path}/pages")
    assert sum(len(folders) for _, folders, _ in os.walk(tmp_path)) < 10
    read = d.read_documents(spark, f"{tmp_path}/pages", "*.txt").select(page_of_path(), "html")
    want = [(n, f"page {n}ä\n") for n in range(300)] + [(300, "\n"), (301, "a\nb\n")]
    assert sorted(rows(read)) == want


def test_markup_is_read_in_pieces(spark):
    seen = []
    run = raw_text(lambda html: seen.append(html) or html).func
    read = run(iter([pa.array([None, "x" * PIECE_BYTES, "y", "z" * PIECE_BYTES]), pa.array([], pa.string())]))
    assert len(next(read)) == 2 and len(seen) == 2
    assert [len(piece) for piece in read] == [1, 1]


def test_calls_of_a_batch_stay_whole_in_pieces(spark):
    calls = []
    run = scorer(lambda prompts: calls.append(len(prompts)) or prompts, batch_size=2).func
    prompts = ["x" * PIECE_BYTES, None, "a", "b", "y" * PIECE_BYTES, "c"]
    found = [row["response"] for piece in run(iter([pa.array(prompts)])) for row in piece.to_pylist()]
    assert found == prompts and calls == [2, 2, 1]


def test_many_labels_are_cut_to_the_lengths_asked_for(spark):
    labels = [(n, f"Label {n:03d}") for n in range(20)] + [(5, "label 005 b"), (None, "zz 00")]
    taxonomy = spark.createDataFrame(labels, "ordinal int, event_type string")
    given = spark.createDataFrame([(g,) for g in ("LABEL 003", "see label 004!", "00", "005", "b", "q", "", None)], "given string")
    want = [("", "zz 00"), ("00", "zz 00"), ("005", "Label 005"), ("LABEL 003", "Label 003"), ("b", "Label 000"),
            ("q", None), ("see label 004!", "Label 004"), (None, None)]
    for most in (0, 100):
        found = d.normalize_labels(given, taxonomy, "given", most_in_row=most)
        assert sorted(rows(found), key=lambda r: (r[0] is None, r[0])) == want
    found = d.normalize_labels(given, taxonomy, "given", most_in_row=0)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_copies_are_left_out_of_the_search(spark):
    docs = spark.createDataFrame([(n, f"a b c d e f g h i {n // 50}") for n in range(100)], "doc_id long, text string")
    plans = []
    shared, ngram_join.token_of = ngram_join.token_of, lambda sets: plans.append(sets) or shared(sets)
    try:
        found = ngram_join.ngram_jaccard_join(docs, 3, 90)
    finally:
        ngram_join.token_of = shared
    assert {(r["doc_id"] // 50, r["component_id"]) for r in found.collect()} == {(0, 0), (1, 50)}
    assert "bits" in plans[0]._jdf.queryExecution().optimizedPlan().toString()


def test_grams_are_dealt_by_the_length_of_texts(spark, monkeypatch):
    monkeypatch.setattr(keywords, "MOST_CONSTANTS", 1)
    monkeypatch.setattr(keywords, "TASK_CHARACTERS", 10)
    docs = spark.createDataFrame([(1, "The end, the END"), (1, "an end"), (2, "no word"), (3, None)], "doc_id long, text string")
    taxonomy = spark.createDataFrame([(1, "a", True, ["end", "the", "an"]), (2, "b", False, ["word", "the end"])],
                                     "ordinal int, event_type string, relevant boolean, keywords array<string>")
    found = keywords.keyword_hits(docs, taxonomy, "doc_id")
    assert sorted(rows(found)) == [(1, "a", 3), (1, "b", 1), (2, "b", 1)]
    logical = found._jdf.queryExecution().analyzed().toString()
    assert len(re.findall(r"RepartitionByExpression \[word#\d+\], 3", logical)) == 2  # 29 characters in all
    docs = docs.union(docs)
    logical = keywords.keyword_hits(docs, taxonomy, "doc_id")._jdf.queryExecution().analyzed().toString()
    assert len(re.findall(r"RepartitionByExpression \[word#\d+\], 6", logical)) == 2


def test_folders_of_rows_are_cut_without_patterns(spark, tmp_path):
    done = spark.createDataFrame([(c, f"a-{c}", "E", True, "r", 0.8, "cot", "2024-01-01") for c in "xyz"],
                                 "cik string, accession_number string, event_type string, relevant boolean, reasoning string, "
                                 "confidence double, prompt_strategy string, classification_timestamp string")
    d.write_classifications(done, f"{tmp_path}/done")
    runs = Manifests(spark, f"{tmp_path}/done").latest().runs
    loaded = load_parts(spark, f"{tmp_path}/done", [(run, b) for b, found in runs.items() for run in found], CLASSIFICATIONS, "parquet")
    assert {(r["__bucket"], r["__run"]) for r in loaded.collect()} == {(b, run) for b, found in runs.items() for run in found}
    assert "regexp" not in loaded._jdf.queryExecution().optimizedPlan().toString()
