"""Incremental ingestion of landing folders."""
