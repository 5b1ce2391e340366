"""Observation-history analytics on Spark DataFrames, SQL and Structured Streaming."""
