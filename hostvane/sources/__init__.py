"""Readers for landing files, limits and streams, and writers for curated data."""
