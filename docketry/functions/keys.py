"""Identifiers, dates and addresses of filings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stored keys and addresses must equal those users already hold.
CIK_WIDTH = 10
UNKNOWN_COMPANY = "Unknown"
KEY_SUFFIX = "8k"
ARCHIVE_BASE = "https://www.sec.gov/Archives/edgar/data"
DEFAULT_FORM = "8-K"
DEFAULT_DAYS = 30


def pad_cik(c: Column) -> Column:
    """zero-pad to ten digits; longer values stay whole, a missing one becomes zeros."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(F.length(c) < CIK_WIDTH, F.lpad(c, CIK_WIDTH, "0")).otherwise(c)


def clean_accession(c: Column) -> Column:
    """accession number without dashes."""
    return F.replace(c, F.lit("-"), F.lit(""))


def file_key(filing_date: Column, accession: Column) -> Column:
    """F8: ``{date}_{accession}_8k``; the suffix does not depend on the form."""
    return F.concat(filing_date, F.lit("_"), clean_accession(accession), F.lit(f"_{KEY_SUFFIX}"))


def directory_key(cik: Column, filing_date: Column, accession: Column) -> Column:
    """``{cik}_{file key}``."""
    return F.concat(cik, F.lit("_"), file_key(filing_date, accession))


def document_url(cik: Column, accession: Column, base: str = ARCHIVE_BASE) -> Column:
    """address of the full submission text, built on the padded cik."""
    return F.concat(
        F.lit(f"{base}/"), cik, F.lit("/"), clean_accession(accession), F.lit("/"),
        accession, F.lit(".txt"),
    )


def parse_day(c: Column) -> Column:
    """``2024-1-5`` and ``2024-01-05`` become a date, anything else null."""
    shaped = c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z")
    return F.when(shaped, F.try_to_date(c, "yyyy-M-d"))


def normalize_date(c: Column) -> Column:
    """the date as ``yyyy-MM-dd``, null when it is not one."""
    return F.date_format(parse_day(c), "yyyy-MM-dd")


def source_type(c: Column) -> Column:
    """``URL`` when there is a scheme and an authority, else ``File``."""
    is_url = c.rlike(r"^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+")
    return F.when(is_url, F.lit("URL")).otherwise(F.lit("File"))
