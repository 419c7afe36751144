"""Structured Streaming forms of ingest, treatment, minute series and counter rates."""
