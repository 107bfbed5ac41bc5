"""riskloom: transaction-risk analytics as Spark DataFrame transforms and Structured Streaming jobs."""

__version__ = "0.1.0"
