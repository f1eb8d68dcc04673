"""F1-F16, S6, S7 and the selection plan."""

import pytest
from pyspark.sql import functions as F

import docketry as d
from docketry.functions.keys import normalize_date, pad_cik
from docketry.sources.schemas import METADATA, SUBMISSIONS, columns
from helpers import plan, rows


def index(spark, *companies):
    data = [(name, cik, None if forms is None else ((forms, dates, keys),)) for name, cik, forms, dates, keys in companies]
    return spark.createDataFrame(data, SUBMISSIONS)


@pytest.fixture(scope="module")
def filings(spark):
    subs = index(
        spark,
        ("Apple Inc.", "320193", ["8-K", "10-Q", "8-K/A", "8-K"],
         ["2024-01-05", "2024-01-06", "2024-01-07", "2024-1-31"],
         ["0000320193-24-000001", "0000320193-24-000002", "0000320193-24-000003", "0000320193-24-000004"]),
        (None, None, ["8-K", "8-K", "8-K"], ["2024-02-30", "2023-12-31", "2024-03-01"], ["0-1-2", "0-1-3"]),
        ("No Recent", "1", None, None, None),
    )
    return d.explode_filings(subs)


def test_unpivot_keeps_order_and_defaults(filings):
    got = rows(filings.select("cik", "company_name", "form", "filing_date", "position"), "cik", "position")
    assert got == [
        ("0000000000", "Unknown", "8-K", "2024-02-30", 0),
        ("0000000000", "Unknown", "8-K", "2023-12-31", 1),
        ("0000000000", "Unknown", "8-K", "2024-03-01", 2),
        ("0000320193", "Apple Inc.", "8-K", "2024-01-05", 0),
        ("0000320193", "Apple Inc.", "10-Q", "2024-01-06", 1),
        ("0000320193", "Apple Inc.", "8-K/A", "2024-01-07", 2),
        ("0000320193", "Apple Inc.", "8-K", "2024-1-31", 3),
    ]


def test_form_is_exact(filings):
    assert d.filter_form(filings).count() == 5
    assert rows(d.filter_form(filings, "8-K/A").select("accession_number")) == [("0000320193-24-000003",)]


def test_dates_are_inclusive(filings):
    def days(**bounds):
        return [str(r[0]) for r in rows(d.filter_dates(filings, **bounds).select("filing_day"), "filing_day")]

    assert days(start="2024-01-05", end="2024-01-07") == ["2024-01-05", "2024-01-06", "2024-01-07"]
    assert days(start="2024-01-31") == ["2024-01-31", "2024-03-01"]
    assert days(end="2023-12-31") == ["2023-12-31"]
    assert len(days()) == 7


def test_windows(spark, filings):
    def bounds(**request):
        return tuple(str(v) for v in spark.range(1).select(*d.date_window(as_of="2024-02-01", **request)).first())

    assert bounds() == ("2024-01-02", "2024-02-01")
    assert bounds(start="2023-05-01") == ("2023-05-01", "2024-02-01")
    assert bounds(start="2023-05-01", end="2023-06-01") == ("2023-05-01", "2023-06-01")
    assert bounds(end="2023-06-01") == ("2024-01-02", "2024-02-01")
    assert d.last_days(filings, 1, "2024-02-01").count() == 1


def test_unusable_rows_are_quarantined(filings):
    dated, broken = d.split_dated(filings)
    assert dated.count() == 5
    assert rows(broken.select("filing_date", "accession_number"), "filing_date") == [
        ("2024-02-30", "0-1-2"), ("2024-03-01", None)]


@pytest.mark.parametrize(
    "given, expected",
    [("2024-1-5", "2024-01-05"), ("2024-01-05", "2024-01-05"), ("2024-02-30", None), ("24-01-05", None),
     ("2024/01/05", None), ("2024-01-05 ", None), ("", None), (None, None), ("2024-13-01", None)],
)
def test_dates(spark, given, expected):
    df = spark.createDataFrame([(given,)], "day string")
    assert rows(df.select(normalize_date(F.col("day")))) == [(expected,)]


@pytest.mark.parametrize(
    "given, expected", [("320193", "0000320193"), ("12345678901", "12345678901"), ("", "0" * 10), (None, "0" * 10)]
)
def test_cik_padding(spark, given, expected):
    assert rows(spark.createDataFrame([(given,)], "c string").select(pad_cik(F.col("c")))) == [(expected,)]


def test_keys_url_and_metadata(filings):
    one = d.filter_dates(d.filter_form(filings), "2024-01-05", "2024-01-05")
    keyed = d.with_document_url(d.filing_key(one))
    assert rows(keyed.select("filename", "directory", "document_url")) == [(
        "2024-01-05_000032019324000001_8k", "0000320193_2024-01-05_000032019324000001_8k",
        "https://www.sec.gov/Archives/edgar/data/0000320193/000032019324000001/0000320193-24-000001.txt")]
    assert d.to_metadata(one).columns == columns(METADATA)
    assert rows(d.to_metadata(one)) == rows(d.to_metadata(keyed))


def test_companies(spark):
    companies = d.popular_companies(spark)
    assert companies.count() == 10
    assert ("Jpmorgan", "19617") in rows(d.companies_listing(companies))


def test_requests_and_selection(spark, filings):
    requests = spark.createDataFrame(
        [("apple", "999", "2024-1-1", None), (None, "0", None, "2020-01-01"), ("nobody", "320193", None, None),
         (None, None, None, None), ("apple", None, "2024-01-06", "2024-01-31")],
        "name string, cik string, start string, end string")
    resolved, unresolved = d.resolve_company(requests, d.popular_companies(spark))
    assert rows(resolved.select("cik"), "cik") == [("0000000000",), ("0000320193",), ("0000320193",)]
    assert unresolved.count() == 2
    windows = d.request_window(resolved, 45, "2024-02-01")
    assert [tuple(map(str, r)) for r in rows(windows.select("start_day", "end_day"), "start_day")] == [
        ("2023-12-18", "2024-02-01"), ("2024-01-01", "2024-02-01"), ("2024-01-06", "2024-01-31")]
    chosen = d.select_filings(d.filter_form(filings), windows)
    assert rows(chosen.select("accession_number"), "accession_number") == [
        ("0-1-3",), ("0000320193-24-000001",), ("0000320193-24-000004",)]


def test_selection_plan(spark):
    subs = index(spark, ("Apple Inc.", "320193", ["8-K", "10-Q"], ["2024-01-05", "2024-01-06"], ["a-1", "a-2"]))
    requests = spark.createDataFrame([("apple", None, None, None)], "name string, cik string, start string, end string")
    found = d.find_filings(subs, requests, d.popular_companies(spark), as_of="2024-01-10")
    assert rows(found.select("cik", "accession_number", "filename")) == [
        ("0000320193", "a-1", "2024-01-05_a1_8k")]
    assert d.find_filings(subs, requests, d.popular_companies(spark), days=2, as_of="2024-01-10").count() == 0


def test_preview_counts_the_selection(filings):
    shown = d.preview(d.filter_form(filings, "10-Q"))
    assert rows(shown) == [("2024-01-06", "0000320193-24-000002", 1)]


def test_attach_content(spark, filings):
    documents = spark.createDataFrame([("0-1-3", "<p>x</p>"), ("zzz", "y")], "accession_number string, html string")
    joined = d.attach_content(filings.filter("accession_number LIKE '0-1%'"), documents)
    assert rows(joined.select("accession_number", "html"), "accession_number") == [("0-1-2", None), ("0-1-3", "<p>x</p>")]


@pytest.mark.parametrize(
    "given, expected",
    [("https://www.example.org/a", "URL"), ("ftp://h", "URL"), ("C:/x", "File"), ("data/x.html", "File"),
     ("http:///x", "File"), ("http://a b", "URL"), ("mailto:a@b", "File"), ("", "File"), (None, "File"),
     ("://x", "File"), ("1a://x", "File")],
)
def test_source_type(spark, given, expected):
    df = spark.createDataFrame([(given,)], "s string")
    assert rows(d.with_source_type(df, "s").select("source_type")) == [(expected,)]


def test_filters_reach_the_scan(spark, tmp_path, filings):
    path = str(tmp_path / "filings")
    filings.write.parquet(path)
    chosen = d.filter_dates(d.filter_form(spark.read.parquet(path)), "2024-01-01", "2024-12-31")
    text = plan(chosen.select("accession_number"))
    for pushed in ("EqualTo(form,8-K)", "GreaterThanOrEqual(filing_day,2024-01-01)", "LessThanOrEqual(filing_day,2024-12-31)"):
        assert pushed in text
    assert "ReadSchema: struct<form:string,accession_number:string,filing_day:date>" in text


def test_small_request_lists_are_broadcast(spark, tmp_path, filings):
    path = str(tmp_path / "filings")
    filings.write.parquet(path)
    requests = d.request_window(d.popular_companies(spark).select(
        pad_cik(F.col("cik")).alias("cik"), F.lit("2024-01-01").alias("start"), F.lit(None).cast("string").alias("end")))
    text = plan(d.select_filings(spark.read.parquet(path), requests))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and "NestedLoop" not in text


def test_windows_are_merged(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01", "2024-01-10"), ("a", "2024-01-01", "2024-01-03"), ("a", "2024-01-11", "2024-01-12"),
         ("a", "2024-01-02", "2024-01-04"), ("a", "2024-02-01", "2024-02-01"), ("a", "2024-03-02", "2024-03-01"),
         ("b", "2024-01-05", "2024-01-06")], "cik string, start_day string, end_day string")
    days = df.select("cik", F.col("start_day").cast("date").alias("start_day"), F.col("end_day").cast("date").alias("end_day"))
    assert [tuple(map(str, r)) for r in rows(d.merge_windows(days), "cik", "start_day")] == [
        ("a", "2024-01-01", "2024-01-12"), ("a", "2024-02-01", "2024-02-01"), ("b", "2024-01-05", "2024-01-06")]


def test_merged_windows_cover_the_same_days(spark):
    days = spark.range(3000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 7) END").alias("cik"),
        F.expr("date_add(date'2024-01-01', cast(hash(id) % 200 AS int))").alias("start_day"),
        F.expr("date_add(date'2024-01-01', cast(hash(id) % 200 + id % 5 - 1 AS int))").alias("end_day"))
    wide = "explode(sequence(start_day, end_day)) AS day"
    want = days.filter("start_day <= end_day").selectExpr("cik", wide).distinct()
    got = d.merge_windows(days).selectExpr("cik", wide)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_copies_of_a_document_count_once(spark):
    filings = spark.createDataFrame([("a",), ("b",)], "accession_number string")
    copies = spark.range(9000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'a' ELSE concat('x', id) END").alias("accession_number"), F.lit("<p>same</p>").alias("html"))
    joined = d.attach_content(filings, copies)
    assert rows(joined, "accession_number") == [("a", "<p>same</p>"), ("b", None)]
    text = plan(d.one_document_each(copies))
    assert text.index("partial_max") > text.index("Exchange hashpartitioning(accession_number")


def test_missing_arrays_and_unreadable_requests_are_not_lost(spark):
    subs = index(spark, ("Apple Inc.", "320193", ["8-K", "8-K"], ["2024-01-05", "2024-01-06"], None))
    dated, broken = d.split_dated(d.explode_filings(subs))
    assert (dated.count(), broken.count()) == (0, 2)
    requests = spark.createDataFrame(
        [("apple", None, "2024-13-01", None), ("apple", None, None, "soon"), ("nobody", None, None, None), ("apple", None, "", "")],
        "name string, cik string, start string, end string")
    found = d.find_filings_checked(subs, requests, d.popular_companies(spark), as_of="2024-01-10")
    assert [f.count() for f in found] == [0, 1, 2, 2]
