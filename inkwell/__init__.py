"""Spark-first analytics engine for scholarly-journal data."""
