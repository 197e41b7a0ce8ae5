"""Spark jobs for streams of wiki recent-change events: ingest, lake, history, live tables."""
