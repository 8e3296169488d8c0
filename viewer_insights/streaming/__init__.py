"""Incremental (Structured Streaming) form of the viewing-log ingestion."""
