"""Repeat-safe ingestion of arriving files with Structured Streaming."""
