"""Continuous ingestion of vendor files."""
