"""Model runs (full, incremental, sliding window) and the registered queries with their SQL twins."""
