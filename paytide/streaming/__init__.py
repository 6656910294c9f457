"""Structured Streaming ingestion: change events in, versions and partials out."""
