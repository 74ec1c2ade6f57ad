"""Data quality checks and documentation coverage as Spark DataFrame operations."""
