"""Reading answers."""

import random
import re

import pytest
from pyspark.sql import functions as F

import docketry as d
from docketry.operators.responses import (
    LABEL_PATTERNS, PLAIN_REASONING_PATTERNS, REASONING_PATTERNS, result_json,
)
from helpers import first_match, optimized, plan, rows

TAXONOMY = {
    "Acquisition": {"relevant": True},
    "Customer Event": {"relevant": True},
    "Personnel Change": {"relevant": True},
    "Financial Event": {"relevant": True},
    "Other": {"relevant": False},
}


@pytest.fixture(scope="module")
def taxonomy(spark):
    return d.taxonomy_from_dict(spark, TAXONOMY)


def parse(spark, taxonomy, responses):
    df = spark.createDataFrame(list(enumerate(responses)), "n int, response string")
    parsed = d.parse_responses(df, taxonomy).orderBy("n")
    return [
        (r["parse_status"], r["result"]["event_type"] if r["result"] else None, r["stated_relevant"],
         r["result"]["reasoning"] if r["result"] else None, r["blank_label"])
        for r in parsed.collect()
    ]


CASES = [
    ("Event Type: Acquisition, Relevant: true", ("ok", "Acquisition", True, "", False)),
    ("Personnel Change: true", ("ok", "Personnel Change", True, "", False)),
    ("Type: Financial Event, Relevant: false", ("ok", "Financial Event", False, "", False)),
    ("Classification: Other, Significant: false", ("ok", "Other", False, "", False)),
    ("EVENT TYPE: ACQUISITION, RELEVANT: TRUE", ("ok", "Acquisition", True, "", False)),
    ("Event Type: Customer, Relevant: true", ("ok", "Customer Event", True, "", False)),
    ("Event Type: A Customer Event of note, Relevant: true", ("ok", "Customer Event", True, "", False)),
    ("Event Type: Acquisition, Relevant: true\nReasoning: bought\nit all", ("ok", "Acquisition", True, "bought it all", False)),
    ("REASONING:\n a  deal\n\nof size \n\nCLASSIFICATION:\nEvent Type: Other, Relevant: true", ("ok", "Other", True, "a deal of size", False)),
    ("nothing to read here", ("no_match", None, None, None, None)),
    ("Event Type: Invalid Kind, Relevant: true", ("unknown_label", None, True, None, False)),
    ("", ("empty_response", None, None, None, None)),
    (None, ("empty_response", None, None, None, None)),
    ("   ", ("no_match", None, None, None, None)),
    ("**Event Type:** Other, **Relevant:** true", ("no_match", None, None, None, None)),
    ("**REASONING:** big\n**CLASSIFICATION:**\nEvent Type: Other, Relevant: true", ("ok", "Other", True, "** big **", False)),
    ("Note: none", ("unknown_label", None, False, None, False)),
    ("Event Type:  , Relevant: true", ("ok", "Acquisition", True, "", True)),
    ("REASONING:\nCLASSIFICATION:\nEvent Type: Other, Relevant: no", ("unknown_label", None, False, None, False)),
    ("REASONING:\nCLASSIFICATION:\nEvent Type: Other, Relevant: false", ("ok", "Other", False, "CLASSIFICATION: Event Type: Other, Relevant: false", False)),
    ("Event Type: Customer\nEvent, Relevant: true", ("unknown_label", None, True, None, False)),
    ("Event Type:  Other , Relevant: true", ("ok", "Other", True, "", False)),
    ("Other: yes", ("ok", "Other", True, "", False)),
    ("Other: no", ("ok", "Other", False, "", False)),
    ("Because: x\nOther: yes\nReasoning:  ", ("ok", "Other", True, "", False)),
    ("Other: yes\nBecause: it  fits\nthere", ("ok", "Other", True, "it  fits", False)),
    ("Other: yes\nExplanation: so", ("ok", "Other", True, "so", False)),
    ("analysis: fine event type: Other, Relevant: true", ("ok", "Other", True, "fine", False)),
    ("a: true\nEvent Type: Other, Relevant: false", ("ok", "Other", False, "", False)),
    ("Event Type: x: Other, Relevant: true", ("ok", "Other", True, "", False)),
]


def test_cases(spark, taxonomy):
    got = parse(spark, taxonomy, [response for response, _ in CASES])
    assert [(c[0], g) for c, g in zip(CASES, got)] == [(response, want) for response, want in CASES]


def by_hand(response):
    """The contract in Python's own re, for one non-empty response."""
    found = first_match(LABEL_PATTERNS, response)
    if not found:
        return "no_match", None, None, None
    label, word = found[1].strip().lower(), found[2].lower() in ("true", "yes")
    names = list(TAXONOMY)
    exact = [n for n in names if n.lower() == label]
    part = [n for n in names if n.lower() in label or label in n.lower()]
    if not exact + part:
        return "unknown_label", None, word, None
    either = re.IGNORECASE | re.DOTALL
    section = first_match(REASONING_PATTERNS, response, either)
    reason = re.sub(r"\s+", " ", section[1].strip()) if section else ""
    if not reason:
        line = first_match(PLAIN_REASONING_PATTERNS, response, either)
        reason = line[1].strip() if line else ""
    return "ok", (exact + part)[0], word, reason


def test_random_responses(spark, taxonomy):
    rng = random.Random(11)
    tokens = ["Event Type:", "Type:", "Relevant:", "Significant:", "Classification:", "CLASSIFICATION:",
              "REASONING:", "reasoning:", "analysis:", "Because:", "Explanation:", "true", "FALSE", "yes",
              "no", "Other", "customer", "Acquisition", "financial event", ",", ":", "\n", " ", " ",
              "\x1e", " ", "**", "nothing", "ſ", "İ"]
    responses = ["".join(rng.choice(tokens) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 14)))
                 for _ in range(4000)]
    got = parse(spark, taxonomy, responses)
    bad = [(r, g[:4], by_hand(r)) for r, g in zip(responses, got) if g[:4] != by_hand(r)]
    assert not bad[:3]
    assert sum(g[0] == "ok" for g in got) > 100


def test_failed_calls_are_errors(spark, taxonomy):
    df = spark.createDataFrame([("Other: yes", None), (None, "boom")], "response string, error string")
    parsed = d.parse_responses(df, taxonomy, error_col="error")
    assert [r[0] for r in rows(parsed.select("parse_status"))] == ["ok", "error"]


def test_quarantine(spark, taxonomy):
    df = spark.createDataFrame([("Other: yes",), ("z" * 300,)], "response string")
    valid, rejected = d.split_valid(d.parse_responses(df, taxonomy))
    assert valid.count() == 1
    assert [r[:2] for r in rows(rejected.select("parse_status", "response_start", "response"))] == [("no_match", "z" * 100)]
    assert all(r["response"].startswith(r["response_start"]) and len(r["response"]) > 100 for r in rejected.collect())


def test_confidence_and_json(spark, taxonomy):
    df = spark.createDataFrame([("Other: yes",)], "response string")
    parsed = d.parse_responses(df, taxonomy)
    assert rows(parsed.select("result.confidence", result_json(F.col("result")))) == [
        (0.8, '{"event_type":"Other","relevant":true,"confidence":0.8,"reasoning":"","raw_response":"Other: yes"}')
    ]


def test_first_partial_match_follows_taxonomy_order(spark):
    forward = d.taxonomy_from_dict(spark, {"Alpha Event": {}, "Beta Event": {}})
    backward = d.taxonomy_from_dict(spark, {"Beta Event": {}, "Alpha Event": {}})
    df = spark.createDataFrame([("event",), (None,)], "given string")
    assert rows(d.normalize_labels(df, forward, "given").select("label")) == [("Alpha Event",), (None,)]
    assert rows(d.normalize_labels(df, backward, "given").select("label")) == [("Beta Event",), (None,)]


def test_plan_is_narrow_and_parses_once(spark, taxonomy, data):
    events = spark.read.parquet(f"{data}/events.parquet").select(
        "event_id", F.concat(F.lit("Type: "), "event_type", F.lit(", Relevant: true")).alias("response")
    )
    valid, _ = d.split_valid(d.parse_responses(events, taxonomy))
    text = optimized(valid.filter("event_id > 7"))
    assert text.count("Generate explode(array(transform(array(response") == 1
    physical = plan(valid.filter("event_id > 7"))
    assert "EvalPython" not in physical and "Join" not in physical
    assert "GreaterThan(event_id,7)" in physical


def test_partition_invariance(spark, taxonomy):
    df = spark.createDataFrame([(n, f"Customer: {'yes' if n % 3 else 'no'}") for n in range(200)], "n int, response string")
    once = rows(d.parse_responses(df.coalesce(1), taxonomy).select("n", "result", "stated_relevant"), "n")
    assert once == rows(d.parse_responses(df.repartition(16), taxonomy).select("n", "result", "stated_relevant"), "n")


def test_many_labels_are_joined_with_equal_results(spark):
    names = ["Acquisition", "Other", "acquisition of a share", "", "Fin", "finance", "OTHER", "Équipe"]
    for chosen in (names, names[:3] + names[4:], ["Only"]):
        taxonomy = d.taxonomy_from_dict(spark, {name: {} for name in chosen})
        given = ["acquisition", " Acquisition ", "an acquisition!", "acq", "financ", "the finance team", "other", "", "  ", "zzz", None, "ÉQUIPE b", "a", "only", "acq"]
        df = spark.createDataFrame(list(enumerate(given)), "n int, given string")
        want = rows(d.normalize_labels(df, taxonomy, "given"), "n")
        got = d.normalize_labels(df, taxonomy, "given", most_in_row=0)
        assert rows(got.select("n", "given", "label"), "n") == want
        text = plan(got)
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_fifty_thousand_labels(spark):
    taxonomy = spark.range(50_000).select(
        F.col("id").cast("int").alias("ordinal"), F.concat(F.lit("Label "), F.col("id").cast("string"), F.lit(".")).alias("event_type"))
    df = spark.createDataFrame([(1, "label 49999."), (2, "the LABEL 31. again"), (3, "bel 4999"), (4, "label"), (5, "none")], "n int, given string")
    assert rows(d.normalize_labels(df, taxonomy, "given").select("n", "label"), "n") == [
        (1, "Label 49999."), (2, "Label 31."), (3, "Label 4999."), (4, "Label 0."), (5, None)]
