"""Structured Streaming ingest of raw transaction batches."""
