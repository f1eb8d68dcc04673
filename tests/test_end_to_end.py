"""Landed files to stored tables and summaries, as in the README."""

import json

import docketry as d
from helpers import rows

WRAPPER = """<SEC-DOCUMENT>{key}.txt : 20240801
<SEC-HEADER>{key}.hdr.sgml : 20240801
ACCESSION NUMBER:\t\t{key}
</SEC-HEADER>
<DOCUMENT>
<TYPE>8-K
<SEQUENCE>1
<TEXT>
<html><head><title>8-K</title></head><body><div id="header">SEC.gov navigation bar</div>
<p>Item 5.02 {body}</p></body></html>
</TEXT>
</DOCUMENT>
</SEC-DOCUMENT>
"""


def test_from_landed_files_to_counts(spark, tmp_path):
    landed, documents, out = tmp_path / "submissions", tmp_path / "filings", tmp_path / "out"
    landed.mkdir()
    keys = {"0000320193-24-000001": ("2024-07-01", "8-K"), "0000320193-24-000002": ("2024-07-15", "8-K"),
            "0000320193-24-000003": ("2024-07-20", "10-Q"), "0000320193-24-000004": ("2024-06-01", "8-K"),
            "0000320193-24-000005": ("2024-07-31", "8-K")}
    (landed / "CIK0000320193.json").write_text(json.dumps({
        "cik": "320193", "name": "Apple Inc.", "filings": {"recent": {
            "form": [form for _, form in keys.values()], "filingDate": [day for day, _ in keys.values()],
            "accessionNumber": list(keys)}}}))
    (landed / "CIK0000789019.json").write_text(json.dumps({
        "cik": "789019", "name": "Microsoft", "filings": {"recent": {
            "form": ["8-K"], "filingDate": ["2024-07-09"], "accessionNumber": ["0000789019-24-000009"]}}}))
    bodies = {"0000320193-24-000001": "The director announced a resignation.", "0000320193-24-000002": "Nothing a model could name.",
              "0000789019-24-000009": "The chairman announced a resignation."}
    for key, body in bodies.items():
        folder = documents / key.replace("-", "")
        folder.mkdir(parents=True)
        (folder / f"{key}.txt").write_text(WRAPPER.format(key=key, body=body), encoding="utf-8")

    taxonomy = d.default_taxonomy(spark)
    requests = spark.createDataFrame([("apple", None, None, None), (None, "789019", "2024-7-1", None)],
                                     "name string, cik string, start string, end string")
    filings = d.find_filings(d.read_submissions(spark, str(landed)), requests, d.popular_companies(spark), as_of="2024-07-31")
    assert sorted(r[1] for r in rows(d.preview(filings))) == [
        "0000320193-24-000001", "0000320193-24-000002", "0000320193-24-000005", "0000789019-24-000009"]

    def model(prompt):
        return ("REASONING:\nsomeone leaves\n\nCLASSIFICATION:\nEvent Type: personnel, Relevant: false"
                if "resignation." in prompt else "no idea")

    texts = d.with_accession(d.read_documents(spark, str(documents), "*.txt"))
    done = d.process_filings(filings, texts, taxonomy, setup=lambda: model, strategy="cot")
    d.write_metadata(filings, str(out / "metadata"))
    d.write_classifications(d.to_classifications(done), str(out / "classifications"))

    assert rows(d.batch_summary(done, "cot")) == [(4, 4, 2, 0, "cot")]
    metadata = d.read_metadata(spark, str(out / "metadata"))
    classified = d.read_classifications(spark, str(out / "classifications"))
    assert rows(classified.select("cik", "event_type", "relevant", "reasoning", "prompt_strategy", "classification_timestamp"), "cik") == [
        ("0000320193", "Personnel Change", True, "someone leaves", "cot", "2024-07-01"),
        ("0000789019", "Personnel Change", True, "someone leaves", "cot", "2024-07-09")]
    status = d.filing_status(metadata, classified)
    assert len(status.columns) == len(set(status.columns))
    assert rows(status.select("accession_number", "classified"), "accession_number") == [
        ("0000320193-24-000001", True), ("0000320193-24-000002", False), ("0000320193-24-000005", False), ("0000789019-24-000009", True)]
    assert rows(d.event_counts(d.with_month(classified, "classification_timestamp"), ["month"])) == [
        ("2024-07", "Personnel Change", True, 2)]
    assert d.schema_violations(classified, taxonomy).count() == 0
    baseline = d.keyword_classify(d.extract_text(texts).select("accession_number", "text"), taxonomy)
    assert {r[0] for r in rows(baseline.filter("accession_number LIKE '0000789019%'").select("event_type"))} == {"Personnel Change"}
