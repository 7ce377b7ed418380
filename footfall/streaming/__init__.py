"""Arrival-driven ingest on Structured Streaming."""
