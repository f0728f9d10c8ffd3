"""Structured Streaming versions of landing, upsert, dedupe and bars."""
