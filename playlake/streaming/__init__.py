"""Structured Streaming forms of the event-log and ingest work (SRC-6, STR-1..3, STR-10, STR-11)."""
