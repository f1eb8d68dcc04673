"""Scoring, attempts, relevance, end to end."""

import os

import pytest
from pyspark.sql import functions as F

import docketry as d
from docketry.operators.scoring import answer_many
from docketry.plans.classify import filing_texts
from helpers import optimized, plan, rows

TAXONOMY = {
    "Acquisition": {"relevant": True, "description": "Buys", "keywords": ["deal"]},
    "Other": {"relevant": False, "description": "", "keywords": []},
}


@pytest.fixture(scope="module")
def taxonomy(spark):
    return d.taxonomy_from_dict(spark, TAXONOMY)


def counted(folder, answer):
    """A model that leaves one file per call, so calls can be counted across processes."""

    def generate(prompt):
        import uuid

        path = os.path.join(folder, uuid.uuid4().hex)
        with open(path, "w", encoding="utf-8") as out:
            out.write(prompt)
        return answer(prompt, folder)

    return generate


def run(spark, taxonomy, tmp_path, texts, answer, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").coalesce(1)
    folder = str(tmp_path)
    out = d.classify(df, taxonomy, counted(folder, answer), **options)
    # Not sorted by Spark: a sort samples its input first and would call the model again.
    got = rows(out.select("n", "status", "attempts", "failure", "result.event_type", "result.relevant", "stated_relevant"))
    return sorted(got), len(os.listdir(folder))


def test_first_answer_is_enough(spark, taxonomy, tmp_path):
    got, calls = run(spark, taxonomy, tmp_path, ["some text"], lambda p, f: "Event Type: Acquisition, Relevant: false")
    assert got == [(0, "classified", 1, None, "Acquisition", True, False)]
    assert calls == 1


def test_three_attempts_for_invalid_answers(spark, taxonomy, tmp_path):
    got, calls = run(spark, taxonomy, tmp_path, ["some text"], lambda p, f: "no grammar")
    assert got == [(0, "unclassified", 3, "no_match", None, None, None)]
    assert calls == 3


def test_blank_text_is_never_sent(spark, taxonomy, tmp_path):
    got, calls = run(spark, taxonomy, tmp_path, ["", "  \n", None], lambda p, f: "Other: yes")
    assert {r[1:3] for r in got} == {("empty_text", 0)} and calls == 0


def test_errors_are_data(spark, taxonomy, tmp_path):
    def answer(prompt, folder):
        if "bad" in prompt:
            raise RuntimeError("boom")
        return "Other: yes"

    got, calls = run(spark, taxonomy, tmp_path, ["bad one", "good one"], answer, max_retries=1)
    assert got == [(0, "unclassified", 2, "RuntimeError: boom", None, None, None),
                   (1, "classified", 1, None, "Other", False, True)]
    assert calls == 3


def test_later_attempts_count(spark, taxonomy, tmp_path):
    def answer(prompt, folder):
        n = len(os.listdir(folder))
        if n == 1:
            return ""
        if n == 2:
            raise ValueError("second")
        return "Acquisition: no"

    got, calls = run(spark, taxonomy, tmp_path, ["x"], answer)
    assert got == [(0, "classified", 3, None, "Acquisition", True, False)] and calls == 3


def test_setup_runs_once_per_task(spark, taxonomy, tmp_path):
    folder = str(tmp_path)

    def setup():
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return lambda prompt: "Other: yes"

    df = spark.range(50).select(F.lit("prompt").alias("prompt")).coalesce(1)
    assert d.score(df, setup=setup).filter("response = 'Other: yes'").count() == 50
    assert len(os.listdir(folder)) == 1
    with pytest.raises(ValueError):
        d.score(df)


def test_a_pass_is_one_stage_with_one_model(spark, taxonomy, data):
    documents = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    text = plan(d.classify(documents, taxonomy, lambda p: None, max_retries=0).filter("status = 'classified'"))
    assert text.count("ArrowEvalPython") == 1
    assert "Join" not in text and "Exchange hash" not in text
    retried = plan(d.classify(documents, taxonomy, lambda p: "Other: yes" if len(p) % 2 else "bad"))
    assert retried.count("ArrowEvalPython") == 1 and "Join" not in retried and "Exchange hash" not in retried


def test_each_pass_sets_up_once_and_sees_only_what_is_left(spark, taxonomy, tmp_path):
    folder = str(tmp_path)

    def setup(attempt):
        import uuid

        open(os.path.join(folder, f"setup-{attempt}-{uuid.uuid4().hex}"), "w").close()

        def generate(prompt):
            open(os.path.join(folder, f"call-{attempt}-{uuid.uuid4().hex}"), "w").close()
            return "Other: yes" if f"word{attempt}" in prompt else "bad"

        return generate

    texts = ["word1"] * 5 + ["word2"] * 3 + ["word3"] * 2 + ["none", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").coalesce(1)
    out = d.classify(df, taxonomy, setup=setup, strategy="basic")
    got = sorted(rows(out.select("n", "status", "attempts", "failure")))
    assert [r[1:] for r in got] == [("classified", 1, None)] * 5 + [("classified", 2, None)] * 3 + [("classified", 3, None)] * 2 + [
        ("unclassified", 3, "no_match"), ("empty_text", 0, None), ("empty_text", 0, None)]
    made = [f.rsplit("-", 1)[0] for f in os.listdir(folder)]
    assert {m: made.count(m) for m in set(made)} == {
        "setup-1": 1, "setup-2": 1, "setup-3": 1, "call-1": 11, "call-2": 6, "call-3": 3}


def test_no_pass_without_rows_left(spark, taxonomy, tmp_path):
    got, calls = run(spark, taxonomy, tmp_path, ["a", "b"], lambda p, f: "Other: yes", max_retries=9)
    assert {r[1:3] for r in got} == {("classified", 1)} and calls == 2


@pytest.mark.parametrize("size", [1, 3, 8, 100])
def test_a_failing_prompt_is_found_in_its_batch(size):
    calls = []

    def many(prompts):
        calls.append(len(prompts))
        if any(p.startswith("bad") for p in prompts):
            raise RuntimeError("boom")
        return [p.upper() for p in prompts][: 2 if "short" in prompts and len(prompts) > 1 else None]

    prompts = ["a", "b", "bad1", "c", "short", "d", "bad2", "e", "f"]
    outcomes = [o for n in range(0, len(prompts), size) for o in answer_many(many, prompts[n: n + size])]
    assert outcomes == [(None, "RuntimeError: boom") if p.startswith("bad") else (p.upper(), None) for p in prompts]
    assert len(calls) <= 2 * len(prompts) - 1 and max(calls) <= size


def test_batches_of_prompts(spark, taxonomy, tmp_path):
    folder = str(tmp_path)

    def many(prompts):
        import uuid

        open(os.path.join(folder, f"{len(prompts)}-{uuid.uuid4().hex}"), "w").close()
        return [None if "7" in p else f"Other: yes {p}" for p in prompts]

    df = spark.range(50).select(F.expr("CASE WHEN id % 10 != 3 THEN concat('prompt ', id) END").alias("prompt")).coalesce(1)
    found = rows(d.score(df, many, batch_size=20).select("prompt", "response", "error"))
    assert all(r[1] == (f"Other: yes {r[0]}" if r[0] and "7" not in r[0] else None) and r[2] is None for r in found)
    assert sorted(f.split("-")[0] for f in os.listdir(folder)) == ["20", "20", "5"]
    with pytest.raises(ValueError):
        d.score(df, many, batch_size=0)
    texts = spark.createDataFrame([(1, "a text"), (2, "")], "n int, text string")
    got = d.classify(texts, taxonomy, lambda prompts: ["Other: yes"] * len(prompts), batch_size=4)
    assert sorted(rows(got.select("n", "status"))) == [(1, "classified"), (2, "empty_text")]


def test_strategies_end_to_end(spark, taxonomy):
    page = spark.createDataFrame(
        [("https://example.org/a.htm", "<p>Apple closed a deal today</p>"), ("local/b.html", "<p>short</p>")],
        "path string, html string")
    for strategy in ("basic", "detailed", "cot", "few_shot"):
        out = d.classify_documents(page, taxonomy, lambda p: "Type: acquisition, Relevant: false", strategy, max_retries=0)
        got = rows(out.select("input_source", "source_type", "strategy", "text_length", "extracted_text", "classification.event_type"))
        assert got == [("https://example.org/a.htm", "URL", strategy, 25, "Apple closed a deal today", "Acquisition")]
    report = d.render_report(out).first()["report"]
    assert "Confidence: 80.0%" in report and "Relevant: Yes" in report and "REASONING" not in report
    assert "Text Length: 25 characters" in report


def test_strategies_are_compared(spark, taxonomy):
    texts = spark.createDataFrame([(1, "a deal"), (2, "a date")], "n int, text string")

    def model(prompt):
        if "sorted like this" in prompt:
            return "Other: no"
        return "Acquisition: yes" if "a deal" in prompt or "think aloud" in prompt else "Other: no"

    fanned = d.classify(d.fan_out_strategies(texts), taxonomy, model, F.col("strategy"), max_retries=0)
    votes = fanned.select("n", F.col("result.event_type").alias("event_type"))
    assert rows(d.strategy_consensus(votes, taxonomy, "n"), "n") == [(1, "Acquisition", 4, 0.75), (2, "Other", 4, 0.75)]
    odd = d.classify(texts.withColumn("strategy", F.lit("guess")), taxonomy, model, F.col("strategy"), max_retries=0)
    assert {r[:] for r in rows(odd.select("status", "attempts"))} == {("unclassified", 0)}


def test_a_label_that_the_taxonomy_has_twice(spark):
    twice = spark.createDataFrame(
        [(0, "Acquisition", True), (1, "Other", False), (2, "Acquisition", False)], "ordinal int, event_type string, relevant boolean")
    df = spark.createDataFrame([("k", "Acquisition", False, 0.5), ("k", "Other", True, 0.5)],
                               "accession_number string, event_type string, stated_relevant boolean, confidence double")
    rated = d.apply_relevance(df, twice)
    assert rows(rated.select("event_type", "relevant"), "event_type") == [("Acquisition", True), ("Other", False)]
    assert rows(d.strategy_consensus(df, twice, "accession_number")) == [("k", "Acquisition", 2, 0.5)]
    assert d.schema_violations(rated, twice).count() == 0
    odd = df.withColumn("event_type", F.lit("Nope")).withColumn("relevant", F.lit(True))
    assert d.schema_violations(odd, twice).count() == 2


def test_report_of_attempts_takes_one_shuffle(spark):
    df = spark.createDataFrame([("k", 2, "no_match"), ("k", 2, "error"), ("k", 3, "no_match"), ("k", 0, "ok"), ("j", 1, "ok")],
                               "k string, attempt int, parse_status string")
    report = d.attempt_report(df, "k")
    assert rows(report, "k") == [("j", True, 1, None), ("k", False, 2, "no_match")]
    assert plan(report).count("Exchange") == 1
    with pytest.raises(ValueError):
        d.attempt_report(df, "k", max_retries=63)


def attempts(spark, *answers):
    return spark.createDataFrame([("k", n, a) for n, a in answers], "k string, attempt int, response string")


@pytest.mark.parametrize(
    "answers, label, used, failure",
    [
        ([(1, "Other: yes")], "Other", 1, None),
        ([(1, ""), (2, "Other: yes")], "Other", 2, None),
        ([(1, "bad"), (2, None), (3, "Acquisition: no")], "Acquisition", 3, None),
        ([(1, "bad"), (2, "bad"), (3, "Unheard: yes"), (4, "Other: yes")], None, 3, "unknown_label"),
        ([(2, "Acquisition: no"), (1, "Other: yes"), (3, "Acquisition: no")], "Other", 1, None),
    ],
)
def test_first_valid_attempt(spark, taxonomy, answers, label, used, failure):
    parsed = d.parse_responses(attempts(spark, *answers), taxonomy)
    chosen = rows(d.first_valid(parsed, "k").select("result.event_type", "attempt"))
    assert chosen == ([(label, used)] if label else [])
    assert rows(d.attempt_report(parsed, "k")) == [("k", label is not None, used, failure)]


def test_hot_key_is_reduced_before_the_shuffle(spark, taxonomy):
    df = spark.range(20000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END").alias("k"), F.expr("cast(id % 4 + 1 AS int)").alias("attempt"),
        F.expr("CASE WHEN id % 7 = 0 THEN concat('Other: yes ', id) ELSE 'bad' END").alias("response"))
    parsed = d.parse_responses(df, taxonomy)
    text = plan(d.first_valid(parsed, "k"))
    assert text.index("partial_min_by") > text.index("Exchange hashpartitioning(k")
    got = d.first_valid(parsed, "k")
    assert rows(got.filter("k = -1").select("attempt")) == [(1,)]
    expected = df.filter("attempt <= 3 AND response != 'bad'").select("k").distinct().count()
    assert got.count() == expected


def test_relevance(spark, taxonomy):
    df = spark.createDataFrame([("Acquisition", False), ("Other", True), ("Free", True), (None, False)],
                               "event_type string, stated_relevant boolean")
    rated = d.apply_relevance(df, taxonomy)
    assert rows(rated.select("event_type", "relevant"), "event_type") == [
        (None, False), ("Acquisition", True), ("Free", True), ("Other", False)]
    assert rows(d.relevance_conflicts(rated), "event_type") == [
        ("Acquisition", False, True, 1), ("Other", True, False, 1)]


def test_relevance_is_a_broadcast_join(spark, taxonomy, data):
    events = spark.read.parquet(f"{data}/events.parquet").withColumn("stated_relevant", F.lit(True))
    text = plan(d.apply_relevance(events, taxonomy))
    assert "BroadcastHashJoin" in text
    # The only shuffle is that of the taxonomy, whose labels are made single.
    shuffles = [line for line in text.splitlines() if "Exchange hash" in line]
    assert len(shuffles) == 1 and "event_id" not in shuffles[0] and text.index("event_id") < text.index("BroadcastExchange")


def test_process_filings(spark, taxonomy):
    filings = spark.createDataFrame(
        [("1", "A", "8-K", "2024-01-01", key) for key in ("a", "b", "c", "d")],
        "cik string, company_name string, form string, filing_date string, accession_number string")
    documents = spark.createDataFrame(
        [("a", "<p>a long line about a deal</p>"), ("b", "<p>x</p>"), ("d", ""), ("zz", "<p>not asked for at all</p>")],
        "accession_number string, html string")
    done = d.process_filings(filings, documents, taxonomy, lambda p: "REASONING: r CLASSIFICATION: Event Type: Acquisition, Relevant: false", max_retries=0)
    assert rows(done.select("accession_number", "status", "attempts"), "accession_number") == [
        ("a", "classified", 1), ("b", "empty_text", 0), ("c", "no_content", 0), ("d", "no_content", 0)]
    records = d.to_classifications(done)
    assert rows(records) == [("1", "a", "Acquisition", True, "r", 0.8, "detailed", "2024-01-01")]
    only = d.process_filings(filings, documents)
    assert only.columns and {r[0] for r in rows(only.select("status"))} == {"metadata_only"}
    assert "documents" not in optimized(only)
    status = d.filing_status(d.to_metadata(filings), records.drop("cik"))
    assert rows(status.select("accession_number", "classified"), "accession_number") == [
        ("a", True), ("b", False), ("c", False), ("d", False)]
    assert rows(d.unclassified(filings, records).select("accession_number"), "accession_number") == [("b",), ("c",), ("d",)]
    assert rows(d.batch_summary(done, "detailed")) == [(4, 4, 1, 0, "detailed")]


def test_copies_of_documents_and_those_that_cannot_be_read(spark, taxonomy):
    filings = spark.createDataFrame(
        [("1", "A", "8-K", "2024-01-01", key) for key in ("a", "b", "c", "d", "e")],
        "cik string, company_name string, form string, filing_date string, accession_number string")
    documents = spark.createDataFrame(
        [("a", "f/2", "<p>the second copy of this one</p>"), ("a", "f/1", "<p>the first copy of this one</p>"),
         ("b", "f/3", "begin 644 picture.jpg\nM1234567890"), ("c", "f/4", "<p>the same text in both copies</p>"),
         ("c", "f/5", "<p>the same text in both copies</p>"), ("d", "f/6", ""), ("zz", "f/7", "<p>not asked for at all</p>"),
         ("e", None, "<p>a document without a path</p>")],
        "accession_number string, path string, html string")

    def model(prompt):
        return "Acquisition: yes" if "first" in prompt else "Other: yes"

    for limit in (100, 2):  # few filings are broadcast; more are joined behind the extraction
        texts = filing_texts(filings, documents, limit)
        assert rows(texts.select("accession_number", "text", "__no_content", "__read_error"), "accession_number") == [
            ("a", "the first copy of this one", False, None), ("b", None, False, "ValueError: an encoded attachment, not text"),
            ("c", "the same text in both copies", False, None), ("d", "", True, None)]
        text = plan(texts)
        for line in text.splitlines():
            if any(node in line for node in ("Sort ", "Exchange hash", "Aggregate(")):
                assert "html" not in line
    done = d.process_filings(filings, documents, taxonomy, model)
    assert rows(done.select("accession_number", "status", "failure", "result.event_type"), "accession_number") == [
        ("a", "classified", None, "Acquisition"), ("b", "unreadable", "ValueError: an encoded attachment, not text", None),
        ("c", "classified", None, "Other"), ("d", "no_content", None, None), ("e", "no_content", None, None)]
    assert rows(d.batch_summary(done, "detailed")) == [(5, 4, 2, 1, "detailed")]
    watched, summary = d.observe_summary(done)
    watched.write.format("noop").mode("overwrite").save()
    assert rows(d.observed_summary(spark, summary, "detailed")) == [(5, 4, 2, 1, "detailed")]


def test_content_is_shuffled_once_and_never_sorted(spark):
    filings = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "accession_number string, n int")
    documents = spark.createDataFrame(
        [("a", "p2", 1, "two"), ("a", "p1", 9, "one"), ("a", "p0", 9, "zero"), ("x", "p3", 9, "other")],
        "accession_number string, path string, length int, html string")
    for given, want in ((documents, "zero"), (documents.drop("length"), "zero"), (documents.withColumn("length", -F.col("length")), "two")):
        out = d.attach_content(filings, given)
        assert out.columns == ["accession_number", "n", "html"]
        assert rows(out, "n") == [("a", 1, want), ("b", 2, None), ("a", 3, want), (None, 4, None)]
    text = plan(out)
    carried = [line for line in text.splitlines() if "html" in line]
    assert not [line for line in carried if "Sort" in line or "Aggregate" in line]
    assert "ShuffledHashJoin" in text


def test_document_partitions_do_not_matter(spark, taxonomy, data):
    documents = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")

    def model(prompt):
        return "Other: yes" if len(prompt) % 2 else "bad"

    columns = ("doc_id", "status", "attempts", "failure", "result")
    one = rows(d.classify(documents.coalesce(1), taxonomy, model).select(*columns), "doc_id")
    assert one == rows(d.classify(documents.repartition(16), taxonomy, model).select(*columns), "doc_id")
