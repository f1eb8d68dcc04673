"""Filings that arrive over time."""
