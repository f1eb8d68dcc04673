"""From submission indexes and requests to the filings wanted."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from docketry.functions.keys import DEFAULT_DAYS, DEFAULT_FORM
from docketry.operators.filings import (
    explode_filings, filing_key, filter_form, request_window, resolve_company, select_filings,
    split_dated, split_windows, with_document_url,
)


class Found(NamedTuple):
    """Filings, and what could not be used: nobody is lost without a trace."""

    filings: DataFrame
    unresolved: DataFrame  # requests that name no known company and no cik
    undated_requests: DataFrame  # requests whose dates cannot be read
    broken_filings: DataFrame  # index rows without a usable date or key


def find_filings(
    submissions: DataFrame,
    requests: DataFrame,
    companies: DataFrame,
    form: str = DEFAULT_FORM,
    days: int = DEFAULT_DAYS,
    as_of=None,
) -> DataFrame:
    """Filings of one form for many requests (``name, cik, start, end``) in one pass.

    Form and date tests come before any document is read. Requests that name nobody or have
    unreadable dates select nothing; :func:`find_filings_checked` returns them, too.
    """
    return find_filings_checked(submissions, requests, companies, form, days, as_of).filings


def find_filings_checked(
    submissions: DataFrame,
    requests: DataFrame,
    companies: DataFrame,
    form: str = DEFAULT_FORM,
    days: int = DEFAULT_DAYS,
    as_of=None,
) -> Found:
    """:func:`find_filings` together with its three quarantine frames."""
    resolved, unresolved = resolve_company(requests, companies)
    wanted, undated = split_windows(request_window(resolved, days, as_of))
    dated, broken = split_dated(filter_form(explode_filings(submissions), form))
    chosen = select_filings(dated, wanted.select("cik", "start_day", "end_day"))
    return Found(with_document_url(filing_key(chosen)), unresolved, undated, broken)
