"""Queries of the text operators on the given tables."""
