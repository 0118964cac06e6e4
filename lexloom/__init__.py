"""lexloom: text, token and embedding analytics as plain Spark DataFrame jobs."""

__version__ = "0.1.0"
