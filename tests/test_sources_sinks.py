"""Files in, tables out."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import docketry as d
from docketry.sinks import counts, tables
from docketry.sinks.counts import maintained_counts
from docketry.sinks.manifest import Manifest, Manifests
from docketry.sinks.tables import bucket_of, stored_keys, vacuum
from docketry.sources.schemas import METADATA
from docketry.sources.taxonomy import DEFAULT_TAXONOMY
from helpers import plan, rows


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=2), encoding="utf-8")
    return str(path)


def test_submissions(spark, tmp_path):
    put(tmp_path / "CIK1.json", {
        "cik": "320193", "name": "Apple Inc.", "extra": {"x": 1},
        "filings": {"recent": {"form": ["8-K", "10-K"], "filingDate": ["2024-01-02", "2024-02-03"],
                               "accessionNumber": ["a-1", "a-2"], "size": [1, 2]}, "files": [{"name": "older"}]}})
    put(tmp_path / "CIK2.json", {"cik": 7, "filings": {}})
    subs = d.read_submissions(spark, str(tmp_path))
    assert rows(subs.select("cik", "name"), "cik") == [("320193", "Apple Inc."), ("7", None)]
    assert rows(d.explode_filings(subs).select("cik", "form", "accession_number"), "position") == [
        ("0000320193", "8-K", "a-1"), ("0000320193", "10-K", "a-2")]


def test_documents(spark, tmp_path):
    put(tmp_path / "b" / "0000320193-24-000080.html", "<p>été\nsecond</p>")
    put(tmp_path / "a.html", "x")
    put(tmp_path / "c.txt", "no")
    documents = d.with_accession(d.read_documents(spark, str(tmp_path)))
    got = {os.path.basename(r["path"]): (r["html"], r["accession_number"]) for r in documents.collect()}
    assert got == {"0000320193-24-000080.html": ("<p>été\nsecond</p>", "0000320193-24-000080"), "a.html": ("x", None)}
    listing = d.list_documents(spark, str(tmp_path))
    assert [os.path.basename(r[0]) for r in rows(listing)] == ["a.html", "0000320193-24-000080.html"]
    assert [r["length"] for r in listing.collect()] == [1, 19]
    assert "content" not in plan(listing).split("ReadSchema")[1]


def test_accession_without_dashes(spark):
    df = spark.createDataFrame([("x/000032019324000080/full.txt",), ("x/000032019324000080.txt",)], "path string")
    assert rows(d.with_accession(df).select("accession_number")) == [(None,), ("0000320193-24-000080",)]


def test_taxonomy_file(spark, tmp_path):
    path = put(tmp_path / "t.json", '{"B": {"relevant": true}, "A": {"description": "d", "keywords": ["k", "l"]},'
                                    ' "C": {}, "B": {"relevant": false, "description": "again"}}')
    assert rows(d.read_taxonomy(spark, path).select("event_type", "relevant", "description", "keywords"), "ordinal") == [
        ("B", False, "again", []), ("A", False, "d", ["k", "l"]), ("C", False, "", [])]
    with pytest.raises(AnalysisException):
        d.read_taxonomy(spark, str(tmp_path / "missing.json"))
    with pytest.raises(Exception, match="MALFORMED"):
        d.read_taxonomy(spark, put(tmp_path / "broken.json", "{'A': ")).collect()
    assert d.read_taxonomy(spark, put(tmp_path / "empty.json", "{}")).count() == 0


def test_taxonomy_mapping_and_default(spark, tmp_path):
    with pytest.raises(ValueError):
        d.taxonomy_from_dict(spark, {})
    default = rows(d.default_taxonomy(spark), "ordinal")
    assert len(default) == 11 and sum(r[2] for r in default) == 9
    assert default[0][1] == "Acquisition" and default[-1][1] == "Other" and default[-1][4] == []
    path = put(tmp_path / "default.json", DEFAULT_TAXONOMY)
    assert rows(d.read_taxonomy(spark, path), "ordinal") == default
    assert rows(d.load_taxonomy(spark, path, {"X": {}}).select("event_type")) == [("X",)]
    assert d.load_taxonomy(spark, path).count() == d.load_taxonomy(spark).count() == 11


def test_stored_results(spark, tmp_path):
    record = {"accession_number": "a-1", "event_type": "Other", "relevant": False, "reasoning": "é", "confidence": 0.8,
              "prompt_strategy": "detailed", "classification_timestamp": "2024-08-01"}
    put(tmp_path / "320193" / "0000320193" / "x" / "classification.json", record)
    put(tmp_path / "320193" / "0000320193" / "x" / "metadata.json", {"cik": "0000320193", "accession_number": "a-1"})
    assert rows(d.read_results(spark, str(tmp_path))) == [tuple(record.values())]
    assert rows(d.read_metadata_files(spark, str(tmp_path)).select("cik")) == [("0000320193",)]


def filings(spark, *entries):
    return spark.createDataFrame(
        [(cik, name, "8-K", day, key) for cik, name, day, key in entries],
        "cik string, company_name string, form string, filing_date string, accession_number string")


def files_below(folder):
    return {os.path.relpath(os.path.join(d_, f), folder) for d_, _, names in os.walk(folder) for f in names if not f.startswith((".", "_"))}


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_metadata_is_replaced_by_key(spark, tmp_path, fmt):
    root = str(tmp_path / "metadata")
    d.write_metadata(filings(spark, ("0000000001", "A", "2024-01-01", "x-1"), ("0000000001", "A", "2024-01-02", "x-2"),
                             ("0000000002", "B", "2024-01-01", "y-1")), root, fmt)
    first = Manifests(spark, root).latest()
    again = filings(spark, ("0000000001", "A2", "2024-01-02", "x-2"), ("0000000003", "C", "2024-01-01", "z-1"),
                    ("0000000003", "C", "2024-01-01", "z-1"))
    for _ in range(2):
        d.write_metadata(again, root, fmt)
    stored = d.read_metadata(spark, root, fmt)
    assert rows(stored.select("cik", "company_name", "accession_number", "filename"), "accession_number") == [
        ("0000000001", "A", "x-1", "2024-01-01_x1_8k"), ("0000000001", "A2", "x-2", "2024-01-02_x2_8k"),
        ("0000000002", "B", "y-1", "2024-01-01_y1_8k"), ("0000000003", "C", "z-1", "2024-01-01_z1_8k")]
    # The folder of the second company is the one of the first run; a new filing of it is added beside.
    second = {b: runs for b, runs in Manifests(spark, root).latest().runs.items()}
    same = [b for b, runs in first.runs.items() if second[b] == runs]
    assert len(same) == 1
    d.write_metadata(filings(spark, ("0000000002", "B", "2024-01-09", "y-2")), root, fmt)
    third = Manifests(spark, root).latest()
    assert third.runs[same[0]][:-1] == first.runs[same[0]] and third.number == 4
    assert d.read_metadata(spark, root, fmt).count() == 5
    some = d.read_metadata(spark, root, fmt, companies=["0000000002", "none"])
    assert rows(some.select("accession_number"), "accession_number") == [("y-1",), ("y-2",)]
    assert {f.split("bucket=")[1].split("/")[0] for f in some.inputFiles()} == {str(same[0])}
    # Folders of old versions go on demand, and all rows are still there.
    before = files_below(root)
    vacuum(spark, root, keep=1)
    assert files_below(root) < before
    assert d.read_metadata(spark, root, fmt).count() == 5
    vacuum(spark, root, keep=1)
    assert d.read_metadata(spark, root, fmt).count() == 5


def test_a_run_reads_only_the_buckets_and_the_dates_of_its_keys(spark, tmp_path):
    root = str(tmp_path / "metadata")
    many = [(f"{n:010d}", "A", f"2024-01-{1 + n % 28:02d}", f"x-{n}") for n in range(300)]
    d.write_metadata(filings(spark, *many), root)
    manifest = Manifests(spark, root).latest()
    assert len(manifest.runs) > 50
    (bucket,) = spark.createDataFrame([("0000000007",)], "cik string").select(bucket_of(F.col("cik"), manifest.buckets)).first()
    keys = stored_keys(spark, manifest, root, METADATA, ["cik", "filename"], "parquet", {bucket}, ("2024-01-08_x", "2024-01-09"))
    assert {f.split("bucket=")[1].split("/")[0] for f in keys.inputFiles()} == {str(bucket)}
    scan = plan(keys)
    assert "GreaterThanOrEqual(filename,2024-01-08_x)" in scan and "LessThanOrEqual(filename,2024-01-09)" in scan
    assert "company_name" not in scan.split("ReadSchema")[1]
    d.write_metadata(filings(spark, ("0000000007", "B", "2024-01-08", "x-7")), root)
    after = Manifests(spark, root).latest()
    assert {b for b in after.runs if after.runs[b] != manifest.runs.get(b)} == {bucket}
    assert rows(d.read_metadata(spark, root, companies=["0000000007"]).select("company_name")) == [("B",)]
    assert d.read_metadata(spark, root).count() == 300


def test_a_run_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "metadata")
    d.write_metadata(filings(spark, ("0000000001", "A", "2024-01-01", "x-1"), ("0000000002", "A", "2024-01-01", "y-1")), root)
    old, seen = rows(d.read_metadata(spark, root), "cik"), files_below(root)
    again = filings(spark, ("0000000001", "B", "2024-01-01", "x-1"), ("0000000003", "B", "2024-01-01", "z-1"))
    open_before = d.read_metadata(spark, root)

    def dies(self, manifest):
        raise KeyboardInterrupt

    monkeypatch.setattr(Manifests, "commit", dies)
    with pytest.raises(KeyboardInterrupt):
        d.write_metadata(again, root)
    monkeypatch.undo()
    assert rows(d.read_metadata(spark, root), "cik") == old and files_below(root) == seen
    # A manifest whose writer died half way counts for nothing, and its number is not used again.
    with open(os.path.join(root, "_manifests", "000000002"), "w") as out:
        out.write('{"buckets": 64}\n[1, ["run-x"]]\n')
    assert rows(d.read_metadata(spark, root), "cik") == old
    d.write_metadata(again, root)
    assert rows(d.read_metadata(spark, root).select("cik", "company_name"), "cik") == [
        ("0000000001", "B"), ("0000000002", "A"), ("0000000003", "B")]
    assert rows(open_before, "cik") == old  # a reader keeps the version that it has opened
    assert Manifests(spark, root).latest().number == 3
    with pytest.raises(Exception, match="exist"):
        Manifests(spark, root).commit(Manifest(3, 64, {}))
    with pytest.raises(ValueError):
        d.read_metadata(spark, str(tmp_path / "nothing"))


def test_buckets_of_many_runs_are_written_anew(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_RUNS", 3)
    root = str(tmp_path / "metadata")
    for day in range(1, 7):
        d.write_metadata(filings(spark, ("0000000001", "A", f"2024-01-0{day}", f"x-{day}"), (None, "N", f"2024-01-0{day}", "n-1")), root)
        assert all(len(runs) <= 3 for runs in Manifests(spark, root).latest().runs.values())
    assert d.read_metadata(spark, root).count() == 12
    d.write_metadata(filings(spark, (None, "N2", "2024-01-03", "n-1")), root)
    d.write_metadata(filings(spark).limit(0), root)
    assert rows(d.read_metadata(spark, root).filter("company_name = 'N2'").select("cik", "filing_date")) == [(None, "2024-01-03")]
    assert d.read_metadata(spark, root).count() == 12


def test_kept_counts_equal_a_recount(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(counts, "MOST_PARTS", 3)
    root = str(tmp_path / "classifications")

    def results(*given):
        return spark.createDataFrame(
            [(f"{c:010d}", f"x-{c}", label, label != "Other", "", 0.8, "cot", day) for c, label, day in given],
            "cik string, accession_number string, event_type string, relevant boolean, reasoning string,"
            " confidence double, prompt_strategy string, classification_timestamp string")

    def check(by):
        whole = d.with_month(d.read_classifications(spark, root), "classification_timestamp")
        assert sorted(rows(maintained_counts(spark, root, by)), key=repr) == sorted(rows(d.event_counts(whole, by)), key=repr)

    with pytest.raises(ValueError):
        maintained_counts(spark, root)
    labels = ("Other", "Acquisition", "Personnel Change")
    for run in range(6):
        d.write_classifications(results(*[(n, labels[(n + run) % 3], f"2024-0{1 + n % 2}-01") for n in range(run * 3, run * 3 + 9)]), root)
        for by in ([], ["month"], ["cik", "month"]):
            check(by)
    place = [p for p in (tmp_path / "classifications" / "_counts").iterdir()]
    assert len(place) == 3 and all(len(Manifests(spark, str(p)).latest().runs[0]) <= 3 for p in place)
    before = files_below(place[0])
    check([])
    assert files_below(place[0]) == before  # nothing new, nothing written
    d.write_classifications(results((1, "Other", "2024-02-01")), root)
    monkeypatch.setattr(Manifests, "commit", lambda self, manifest: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        maintained_counts(spark, root)
    monkeypatch.undo()
    check([])


def test_classifications(spark, tmp_path):
    root = str(tmp_path / "classifications")
    row = ("0000000001", "x-1", "Other", False, "why", 0.8, "detailed", "2024-01-01")
    schema = ("cik string, accession_number string, event_type string, relevant boolean, reasoning string,"
              " confidence double, prompt_strategy string, classification_timestamp string")
    d.write_classifications(spark.createDataFrame([row], schema), root)
    d.write_classifications(spark.createDataFrame([row[:2] + ("Acquisition", True) + row[4:]], schema), root)
    back = d.read_classifications(spark, root)
    assert rows(back.select("cik", "accession_number", "event_type", "relevant")) == [("0000000001", "x-1", "Acquisition", True)]


def test_model_runs_once_for_a_stored_table(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    folder = str(calls)

    def model(prompt):
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return "Other: yes"

    base = filings(spark, *[("1", "A", "2024-01-01", f"k-{n}") for n in range(6)])
    documents = base.select("accession_number", F.lit("<p>quite a long line of text</p>").alias("html"))
    done = d.process_filings(base, documents, d.default_taxonomy(spark), model)
    root = str(tmp_path / "classifications")
    d.write_classifications(d.to_classifications(done), root)
    assert len(os.listdir(folder)) == 6
    d.write_classifications(d.to_classifications(done), root)
    # What the passes have staged is not asked for again.
    assert len(os.listdir(folder)) == 6 and d.read_classifications(spark, root).count() == 6


def test_a_hot_company_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(30000).select(
        F.expr("CASE WHEN id % 3 < 2 THEN '0000000001' ELSE concat('c', id % 50) END").alias("cik"), F.lit("n").alias("company_name"),
        F.lit("8-K").alias("form"), F.lit("2024-01-01").alias("filing_date"), F.expr("cast(id AS string)").alias("accession_number"))
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    try:
        d.write_metadata(df, str(tmp_path / "m"), "parquet")
    finally:
        for name in sizes:
            spark.conf.unset(name)
    (bucket,) = spark.createDataFrame([("0000000001",)], "cik string").select(bucket_of(F.col("cik"), tables.BUCKETS)).first()
    files = [f for f in files_below(tmp_path / "m") if f"bucket={bucket}/" in f and f.endswith(".parquet")]
    assert len(files) > 1
    assert d.read_metadata(spark, str(tmp_path / "m"), "parquet").count() == 30000


def test_event_counts_and_months(spark):
    df = spark.createDataFrame([("1", "2024-01-05", "Other", False), ("1", "2024-01-09", "Other", False), ("1", "2024-02-01", "Other", False)],
                               "cik string, filing_date string, event_type string, relevant boolean")
    assert rows(d.event_counts(d.with_month(df), ["cik", "month"]), "month") == [
        ("1", "2024-01", "Other", False, 2), ("1", "2024-02", "Other", False, 1)]
    assert (None, None, 3) in rows(d.event_counts(df, totals=True))


def test_report(spark):
    df = spark.sql("""SELECT 'a.html' AS input_source, 'cot' AS strategy, 1234567 AS text_length,
        named_struct('event_type', 'Other', 'relevant', false, 'confidence', 0.8512D, 'reasoning', r, 'raw_response', 'raw') AS classification
        FROM VALUES ('because'), ('') AS t(r)""")
    with_reason, without = [r["report"] for r in d.render_report(df).collect()]
    for part in ("Source: a.html\n", "Text Length: 1,234,567 characters", "Relevant: No", "Confidence: 85.1%",
                 "Why:\nbecause\n", "Answer as given:\nraw\n"):
        assert part in with_reason
    assert "Why" not in without


def test_the_last_row_by_order_is_stored(spark, tmp_path):
    root = str(tmp_path / "ordered")
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(shared))
    both = filings(spark, ("0000000001", "A", "2024-01-01", "x-1")).selectExpr("*", "1 AS n").union(
        filings(spark, ("0000000001", "9", "2024-01-01", "x-1")).selectExpr("*", "2 AS n"))
    for rows_, name in ((both, "9"), (both.withColumn("n", -F.col("n")), "A")):
        d.write_metadata(rows_, root, order=F.col("n"))
        assert rows(d.read_metadata(spark, root).select("company_name")) == [(name,)]
    assert set(os.listdir(shared)) == before
