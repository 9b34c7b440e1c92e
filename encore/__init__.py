"""encore: listening-history analytics on Spark (DataFrame / SQL / ML / Structured Streaming)."""

__version__ = "0.1.0"
