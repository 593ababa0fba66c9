"""MySQL query and dump semantics as native Spark DataFrame operations."""

__version__ = "0.1.0"
