"""Data-quality operators for sky-survey tables as Spark DataFrame operations."""
