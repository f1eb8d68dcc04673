"""Filings that land over time."""

import json

from pyspark.sql import functions as F

import docketry as d
from docketry.streaming.arrivals import (
    KEYED_STATE, arriving_filings, first_arrivals, marked_arrivals, run_available, store_batch, stream_submissions,
)
from helpers import rows


def land(folder, name, cik, *filings):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({
        "cik": cik, "name": f"Company {cik}", "filings": {"recent": {
            "form": ["8-K"] * len(filings), "filingDate": [day for day, _ in filings],
            "accessionNumber": [key for _, key in filings]}}}))


def test_incremental_runs_equal_one_batch(spark, tmp_path):
    landed, root, checkpoint = tmp_path / "landed", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    keys = ("a-1", "a-2", "b-1", "b-2")
    documents = tmp_path / "documents"
    spark.createDataFrame([(k, f"<p>the merger named {k} was closed</p>") for k in keys],
                          "accession_number string, html string").write.parquet(str(documents))
    handle = store_batch(
        root, lambda s, batch: s.read.parquet(str(documents)), d.default_taxonomy,
        lambda prompt: "Acquisition: yes" if "a-" in prompt else "cannot tell", "basic")

    def run():
        stream = arriving_filings(stream_submissions(spark, str(landed)), "8-K")
        query = run_available(first_arrivals(stream), handle, checkpoint)
        query.awaitTermination()
        return query.recentProgress

    land(landed, "1.json", "1", ("2024-01-01", "a-1"), ("2024-13-01", "broken"))
    land(landed, "2.json", "2", ("2024-01-01", "b-1"))
    run()
    assert d.read_metadata(spark, f"{root}/metadata").count() == 2
    land(landed, "3.json", "1", ("2024-01-01", "a-1"), ("2024-01-02", "a-2"))
    land(landed, "4.json", "2", ("2024-01-03", "b-2"), ("2024-01-03", "b-2"))
    run()
    stored = rows(d.read_metadata(spark, f"{root}/metadata").select("cik", "filing_date", "accession_number"), "accession_number")
    batch = d.split_dated(d.explode_filings(d.read_submissions(spark, str(landed))))[0]
    assert stored == rows(batch.select("cik", "filing_date", "accession_number").distinct(), "accession_number")
    classified = d.read_classifications(spark, f"{root}/classifications")
    assert rows(classified.select("accession_number", "event_type", "relevant"), "accession_number") == [
        ("a-1", "Acquisition", True), ("a-2", "Acquisition", True)]


def test_a_copy_within_the_delay_is_dropped(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"

    def add(name, *events):
        spark.createDataFrame(list(events), "accession_number string, arrived_at string").select(
            "accession_number", F.col("arrived_at").cast("timestamp")).write.parquet(str(source / name))

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(str(out / f"batch={batch_id}"))

    def run():
        stream = (spark.readStream.schema("accession_number string, arrived_at timestamp")
                  .option("recursiveFileLookup", True).parquet(str(source)))
        run_available(first_arrivals(stream, ["accession_number"], delay="1 day"), handle, str(tmp_path / "checkpoint")).awaitTermination()

    add("1", ("x", "2024-01-01 00:00:00"), ("x", "2024-01-01 05:00:00"), ("y", "2024-01-01 06:00:00"))
    run()
    add("2", ("x", "2024-01-01 12:00:00"), ("z", "2024-01-01 12:00:00"))
    run()
    assert sorted(rows(spark.read.parquet(str(out)).select("accession_number"))) == [("x",), ("y",), ("z",)]


def test_late_files_and_co_registrants_come_out(spark, tmp_path):
    import os

    landed, out = tmp_path / "landed", tmp_path / "out"

    def run():
        stream = first_arrivals(arriving_filings(stream_submissions(spark, str(landed)), "8-K"))
        run_available(stream, lambda batch, n: batch.write.mode("append").parquet(str(out)), str(tmp_path / "c")).awaitTermination()

    land(landed, "1.json", "1", ("2024-01-01", "a-1"))
    run()
    land(landed, "2.json", "2", ("2024-01-01", "a-1"))
    land(landed, "3.json", "3", ("2024-01-01", "old"))
    os.utime(landed / "3.json", (0, 0))
    run()
    found = rows(spark.read.parquet(str(out)).select("cik", "accession_number"), "cik")
    assert [(c.lstrip("0"), k) for c, k in found] == [("1", "a-1"), ("2", "a-1"), ("3", "old")]


def test_arrivals_are_marked_over_batches(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"

    def add(name, *given):
        spark.createDataFrame(list(given), "cik string, accession_number string, n int").coalesce(1).write.parquet(str(source / name))

    def run():
        stream = spark.readStream.schema("cik string, accession_number string, n int").option("recursiveFileLookup", True).parquet(str(source))
        marked = marked_arrivals(stream, days_kept=1, usable=F.col("n") >= 0)
        write = lambda batch, n: batch.write.mode("append").parquet(str(out))
        query = run_available(marked, write, str(tmp_path / "checkpoint"), KEYED_STATE)
        assert query.awaitTermination(120)
        return sorted(rows(spark.read.parquet(str(out)).select("cik", "accession_number", "arrival")), key=repr)

    add("1", ("1", "x", 1), ("1", "x", 2), ("2", "x", 3), (None, "x", 4), ("1", "y", -1))
    assert run() == [("1", "x", "first"), ("1", "x", "repeat"), ("1", "y", "rejected"), ("2", "x", "first"), (None, "x", "rejected")]
    add("2", ("1", "x", 5), ("1", "y", 6), ("3", "x", None))
    assert run() == [("1", "x", "first"), ("1", "x", "repeat"), ("1", "x", "repeat"), ("1", "y", "first"), ("1", "y", "rejected"),
                     ("2", "x", "first"), ("3", "x", "rejected"), (None, "x", "rejected")]
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_handler_sets_up_a_model_and_keeps_the_last_row(spark, tmp_path):
    root = str(tmp_path / "out")
    batch = spark.createDataFrame(
        [("0000000001", name, "8-K", "2024-01-01", "a-1", n) for n, name in enumerate(["Z", "B", "A"])],
        "cik string, company_name string, form string, filing_date string, accession_number string, n int")
    documents = spark.createDataFrame([("a-1", "f/1", "<p>quite a long line of text</p>")], "accession_number string, path string, html string")
    handle = store_batch(
        root, lambda s, b: documents, d.default_taxonomy, setup=lambda attempt: lambda prompts: ["Other: yes" if attempt == 2 else "no"] * len(prompts),
        order=F.col("n"), batch_size=2)
    for batch_id in (0, 0):
        handle(batch, batch_id)
    assert rows(d.read_metadata(spark, f"{root}/metadata").select("company_name")) == [("A",)]
    assert rows(d.read_classifications(spark, f"{root}/classifications").select("accession_number", "event_type")) == [("a-1", "Other")]
