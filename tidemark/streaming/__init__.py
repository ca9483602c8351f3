"""Structured Streaming forms of the loading, merging, deduplication and alert jobs."""
