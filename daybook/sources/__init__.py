"""Scans (partitioned source, stored tables, test-table adapters) and table sinks."""
