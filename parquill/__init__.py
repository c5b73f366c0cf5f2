"""Typed export of query results as Parquet, on Spark."""

VERSION = "0.1.0"
