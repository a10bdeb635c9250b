"""daybook: incremental daily revenue metrics on Spark (DataFrame API, Catalyst-planned)."""

__version__ = "0.1.0"
