"""Records-archive analytics on Spark: wide extracts, structuring, profiling, search."""

__version__ = "0.1.0"
