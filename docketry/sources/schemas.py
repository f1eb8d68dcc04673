"""Schemas of the tables that go in and out; nothing is ever inferred."""

SUBMISSIONS = (
    "name string, cik string, filings struct<recent: struct<form: array<string>,"
    " filingDate: array<string>, accessionNumber: array<string>>>"
)
TAXONOMY = (
    "ordinal int, event_type string, relevant boolean, description string,"
    " keywords array<string>"
)
TAXONOMY_FILE = (
    "map<string, struct<relevant: boolean, description: string, keywords: array<string>>>"
)
METADATA = (
    "cik string, company_name string, form string, filing_date string,"
    " accession_number string, document_url string, filename string"
)
CLASSIFICATION = (
    "accession_number string, event_type string, relevant boolean, reasoning string,"
    " confidence double, prompt_strategy string, classification_timestamp string"
)
RESULT = (
    "struct<event_type: string, relevant: boolean, confidence: double, reasoning: string,"
    " raw_response: string>"
)
COMPANIES = "name string, cik string"


def columns(schema: str) -> list[str]:
    """Column names of one of the flat schemas above, in order."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).names
