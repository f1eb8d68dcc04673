"""Readers for filing indexes, documents, taxonomies and stored results."""
