"""Structured Streaming trigger for the incremental models (file source -> foreachBatch)."""
