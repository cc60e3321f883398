"""Structured Streaming forms of collection, de-duplication, upsert and daily counts."""
