"""Incremental (exactly-once) file ingest with Structured Streaming."""

from tablewatch.streaming.incremental import ingest_new_files  # noqa: F401
