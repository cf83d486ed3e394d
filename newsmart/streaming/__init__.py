"""Incremental forms of ingest, scoring and de-duplication."""
