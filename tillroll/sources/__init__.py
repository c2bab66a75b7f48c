"""Readers of the source tables, the sales adapter, raw CSV batches and sinks."""
